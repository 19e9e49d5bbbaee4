"""Writers, the ingest ledger and publishing."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arealytics.sources.files import exists, filesystem, hadoop_path, matching


def write_year(df: DataFrame, path: str, year: str = "YEAR", *within: str) -> None:
    """One partition per report year and value of ``within``; a rerun replaces
    only its own partitions.

    The rebalance brings a year's rows together, cuts a large year into
    several tasks and joins small ones, by measured size.
    """
    (
        df.hint("rebalance", F.col(year))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(year, *within)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild, gzip parquet."""
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_fact(df: DataFrame, path: str, by: Sequence[str] = ("monthyear",)) -> None:
    """Gzip parquet laid out by month, so that month filters skip files.

    Ranges run over the month and then a content hash: a month with a large
    part of the rows takes several ranges.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    laid_out = df.withColumn("_content", content)
    write_table(
        laid_out.repartitionByRange(*by, "_content")
        .sortWithinPartitions(*by)
        .drop("_content"),
        path,
    )


def write_plain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def rings_to_polygons(rings: Column) -> Column:
    """GeoJSON MultiPolygon coordinates: each outer ring opens a polygon, the
    holes that follow belong to it."""
    points = F.transform(
        rings,
        lambda r: F.struct(
            r["hole"].alias("hole"),
            F.transform(
                _closed(r["points"]), lambda p: F.array(p["x"], p["y"])
            ).alias("points"),
        ),
    )
    nothing = F.array().cast("array<array<array<array<double>>>>")

    def add(acc: Column, ring: Column) -> Column:
        one = F.array(ring["points"])
        last = F.element_at(acc, -1)
        with_hole = F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat(last, one))
        )
        return F.when(ring["hole"], with_hole).otherwise(F.concat(acc, F.array(one)))

    return F.aggregate(points, nothing, add)


def _closed(points: Column) -> Column:
    first, last = F.element_at(points, 1), F.element_at(points, -1)
    return F.when(first == last, points).otherwise(
        F.concat(points, F.array(first))
    )


def write_geojson(df: DataFrame, path: str, properties: Sequence[str]) -> None:
    """One GeoJSON feature per line."""
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(*properties).alias("properties"),
            F.struct(
                F.lit("MultiPolygon").alias("type"),
                rings_to_polygons(F.col("rings")).alias("coordinates"),
            ).alias("geometry"),
        )
    )
    df.select(feature.alias("value")).write.mode("overwrite").text(path)


def label_values(df: DataFrame, value: str, label: str) -> DataFrame:
    """``{value, label}`` records for a control."""
    return df.select(F.col(f"`{value}`").alias("value"), F.col(f"`{label}`").alias("label"))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_ledger(files: DataFrame, ledger: str) -> None:
    """Remember processed files by name; creates the ledger when absent."""
    files.select("name").distinct().write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not exists(spark, ledger):
        return spark.createDataFrame([], "name string")
    return spark.read.parquet(ledger).select("name").distinct()


def pending_files(listing: DataFrame, present: DataFrame, always: str) -> DataFrame:
    """Files of the listing that the target lacks, and always the full table."""
    known = present.select("name").where(F.col("name") != always).distinct()
    return listing.select("name").distinct().join(known, "name", "left_anti")


def publish(df: DataFrame, path: str, backup: str) -> None:
    """Write beside ``path``, move the present version to ``backup``, swap.

    A failing backup is reported and does not stop the publication.  The old
    version is deleted only after the new one is in its place, and put back
    where that fails.
    """
    spark = df.sparkSession
    staging = path.rstrip("/") + ".staging"
    write_table(df, staging)
    if exists(spark, path):
        try:
            _replace(spark, path, backup)
        except Exception as problem:
            warnings.warn(f"no backup of {path}: {problem!r}", stacklevel=2)
    _replace(spark, staging, path)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    fs = filesystem(spark, target)
    to = hadoop_path(spark, target)
    aside = hadoop_path(spark, target.rstrip("/") + ".old")
    if fs.exists(to):
        if fs.exists(aside):
            fs.delete(aside, True)
        if not fs.rename(to, aside):
            raise OSError(f"cannot move {target} aside")
    if to.getParent() is not None:
        fs.mkdirs(to.getParent())
    if not fs.rename(hadoop_path(spark, source), to):
        if fs.exists(aside):
            fs.rename(aside, to)
        raise OSError(f"cannot move {source} to {target}")
    if fs.exists(aside):
        fs.delete(aside, True)


# --------------------------------------------------------------------------
# Versions: readers follow a pointer, which changes last and at once
# --------------------------------------------------------------------------

_POINTER = "CURRENT"


def publish_version(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write ``df`` as a new version under ``root`` and point to it.

    A reader that follows the pointer sees the old version or the new one,
    never a gap.  The newest ``keep`` versions stay, so that a reader of the
    version before is not cut off.
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    fs = filesystem(spark, root)
    number = max(versions(spark, root), default=0) + 1
    write_table(df, f"{root}/v{number:010d}")
    # the new pointer is complete before it takes the place of the old one
    fresh = hadoop_path(spark, f"{root}/{_POINTER}.{number}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(f"v{number:010d}".encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(
        fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(),
        spark.sparkContext._jsc.hadoopConfiguration(),
    )
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(
        fs.makeQualified(fresh), fs.makeQualified(hadoop_path(spark, f"{root}/{_POINTER}")), options
    )
    for old in sorted(versions(spark, root))[:-keep]:
        fs.delete(hadoop_path(spark, f"{root}/v{old:010d}"), True)
    return f"{root}/v{number:010d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions under ``root``, complete or not."""
    found = matching(spark, f"{root.rstrip('/')}/v??????????")
    return [int(path.rsplit("/v", 1)[1]) for path in found]


def published(spark: SparkSession, root: str) -> DataFrame:
    """The version that the pointer names at this moment."""
    root = root.rstrip("/")
    (line,) = spark.read.text(f"{root}/{_POINTER}").collect()
    return spark.read.parquet(f"{root}/{line[0]}")

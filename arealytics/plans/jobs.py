"""The jobs: new archives to the clean fact, code tables, unit tables.

A home folder holds ``fact`` (by month and archive), ``months`` (month sums by
month), ``ledger``, ``failures`` and ``published``.  Every step replaces whole
partitions, and the ledger is written last: a job that dies is run again and
does the same archives over.  Published tables are versions behind a pointer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from arealytics.operators.aggregates import assign_file_year
from arealytics.operators.filters import drop_null
from arealytics.plans import clean, dimensions, units
from arealytics.session import pin
from arealytics.sinks import (
    append_ledger,
    pending_files,
    publish_version,
    published,
    read_ledger,
)
from arealytics.sources.files import exists, matching
from arealytics.sources.reports import RAW_COLUMNS, read_zipped_reports, text_schema
from arealytics.specs import CHEMICALS, PRODUCTS, SITES, DimensionSpec

SPECS = (CHEMICALS, SITES, PRODUCTS)


@dataclass(frozen=True)
class Ingested:
    """What a run has taken in."""

    archives: list[str]
    failed: list[str]
    months: list[str | None]


def _replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    (
        df.hint("rebalance", F.col(by[0]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _in_months(months: Sequence[str | None]) -> Column:
    """Months are names of folders, so this chooses what is read."""
    known = [m for m in months if m is not None]
    chosen = F.col("monthyear").isin(known) if known else F.lit(False)
    return chosen | F.col("monthyear").isNull() if None in months else chosen


def clean_fact(spark: SparkSession, home: str) -> DataFrame:
    """The stored fact; empty before the first run."""
    raw = spark.createDataFrame([], text_schema(RAW_COLUMNS))
    none = spark.createDataFrame([], "CO_MTRS string, Meridian string")
    shape = clean.clean_use(raw, none).drop("monthyear").schema
    schema = T.StructType(
        [*shape.fields, T.StructField("year", T.IntegerType()),
         T.StructField("monthyear", T.StringType()), T.StructField("archive", T.StringType())]
    )
    if not exists(spark, f"{home}/fact"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{home}/fact")


def stored_months(spark: SparkSession, home: str) -> DataFrame:
    schema = "table string, id string, _lbs double, monthyear string"
    if not exists(spark, f"{home}/months"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{home}/months")


def clean_job(
    spark: SparkSession,
    inbox: str,
    home: str,
    meridians: DataFrame,
    specs: Sequence[DimensionSpec] = SPECS,
) -> Ingested:
    """Archives that the ledger lacks, cleaned into the fact; the month sums of
    the months they touch.  An archive that cannot be read is noted under
    ``failures`` and tried again next time."""
    names = [(p.rsplit("/", 1)[-1],) for p in matching(spark, f"{inbox.rstrip('/')}/*.zip")]
    listing = spark.createDataFrame(names, "name string")
    pending = [r[0] for r in pending_files(listing, read_ledger(spark, f"{home}/ledger"), "").collect()]
    if not pending:
        return Ingested([], [], [])
    raw, failures = read_zipped_reports(spark, inbox, names=pending)
    failed = sorted(r[0].rsplit("/", 1)[-1] for r in failures.select("_file").distinct().collect())
    if failed:
        failures.write.mode("append").parquet(f"{home}/failures")
    done = sorted(set(pending) - set(failed))

    dated = assign_file_year(drop_null(raw, "DATE"), "_file")
    archive = F.element_at(F.split("_file", "/"), -1)
    kept = dated.withColumn("archive", archive)
    fact = pin(
        clean.clean_use(
            kept, meridians, carry=[F.col("YEAR").alias("year"), F.col("archive")]
        )
    )
    months = [r[0] for r in fact.select("monthyear").distinct().collect()]
    if months:
        _replace_partitions(fact, f"{home}/fact", "monthyear", "archive")
        touched = clean_fact(spark, home).where(_in_months(months))
        _replace_partitions(dimensions.month_sums(touched, specs), f"{home}/months", "monthyear")
    append_ledger(spark.createDataFrame([(n,) for n in done], "name string"), f"{home}/ledger")
    return Ingested(done, failed, sorted(months, key=lambda m: (m is None, m or "")))


def meta_job(
    spark: SparkSession,
    home: str,
    codes: dict[str, DataFrame],
    flags: DataFrame,
    restricted: DataFrame,
    specs: Sequence[DimensionSpec] = SPECS,
) -> dict[str, DataFrame]:
    """Code tables with the statistics of the stored months, categories and
    type codes, published."""
    sums = stored_months(spark, home)
    tables = dimensions.tables_of_months(sums, codes, specs)
    in_use = sums.where(F.col("table") == CHEMICALS.name).select(F.col("id").alias("chem_code"))
    active = pin(
        dimensions.keep_known(
            dimensions.flag_restricted(flags, restricted), "chem_code", in_use, "chem_code"
        )
    )
    tables["categories"] = dimensions.categories(active)
    tables["use_type_codes"] = dimensions.use_type_codes(active)
    return publish_all(spark, home, tables)


def unit_job(
    spark: SparkSession, home: str, crosswalks: Mapping[str, DataFrame], fips: DataFrame
) -> dict[str, DataFrame]:
    """Unit tables of the stored fact and the published categories, published;
    the check against the fact is published beside them."""
    fact = clean_fact(spark, home).drop("year", "archive")
    known = published(spark, f"{home}/published/categories")
    base, tables = units.unit_tables(fact, known, crosswalks, fips)
    found = publish_all(spark, home, tables)
    checked = units.reconcile(base, found, units.AG_ONLY)
    return found | publish_all(spark, home, {"reconciliation": checked})


def publish_all(
    spark: SparkSession, home: str, tables: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Every table as a new version, and what readers see now."""
    for name, df in tables.items():
        publish_version(df, f"{home}/published/{name}")
    return {name: published(spark, f"{home}/published/{name}") for name in tables}

"""File listing through the Hadoop filesystem of the path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arealytics.operators.joins import estimated_bytes

_WORTH_SPREADING = 512 * 1024


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def filesystem(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()
    )


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted; empty when there are none."""
    found = filesystem(spark, pattern).globStatus(hadoop_path(spark, pattern))
    return sorted(str(f.getPath()) for f in (found or []))


def exists(spark: SparkSession, path: str) -> bool:
    return filesystem(spark, path).exists(hadoop_path(spark, path))


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few unsplittable pieces (an archive, a file of one row
    group) to all cores.  A scan that already has a piece per core, as any
    large table does, is left alone and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) < _WORTH_SPREADING:
        return df
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)

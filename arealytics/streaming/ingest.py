"""New report files as a stream that ends when all present files are done.

The stream's own checkpoint remembers which files were taken, so a rerun reads
only what has been added since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from arealytics.operators.aggregates import assign_file_year
from arealytics.operators.filters import drop_null
from arealytics.sinks import write_year
from arealytics.sources.reports import RAW_COLUMNS, file_path, text_schema


def report_stream(
    spark: SparkSession, folder: str, columns: Sequence[str] = RAW_COLUMNS
) -> DataFrame:
    """Plain tab-separated reports of a folder as a stream of text columns."""
    return (
        spark.readStream.schema(text_schema(columns))
        .option("sep", "\t")
        .option("header", True)
        .csv(folder)
        .withColumn("_file", file_path())
    )


def ingest_new(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str] = RAW_COLUMNS,
) -> StreamingQuery:
    """Dated rows of new files into ``target``, one partition per file year and
    file.

    A file is never split over batches, so its year is known within one.  A
    batch replaces the files it holds, which makes a repeated batch harmless and
    keeps what other files brought to the same year.
    """

    def store(batch: DataFrame, _number: int) -> None:
        write_year(assign_file_year(batch, "_file"), target, "YEAR", "_file")

    return (
        drop_null(report_stream(spark, folder, columns), "DATE")
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

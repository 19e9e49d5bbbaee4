"""Code tables, survey tables, lists and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from arealytics.functions.text import link_targets
from arealytics.sources.reports import text_schema
from arealytics.specs import DimensionSpec


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Comma-separated text with a header, every column as text, so that codes
    keep their leading zeros."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def read_dimension(spark: SparkSession, path: str, spec: DimensionSpec) -> DataFrame:
    """A code table in latin-1."""
    return read_text_csv(
        spark, path, [spec.file_id, spec.label], encoding="ISO-8859-1"
    )


def read_restricted(spark: SparkSession, path: str) -> DataFrame:
    """Restricted materials: four positional columns, of which code and flag
    are kept; the first data row is a second header."""
    raw = spark.read.option("header", True).csv(path)
    named = raw.toDF("name", "chem_code", "flag", *raw.columns[3:])
    return drop_header_rows(named, "name", ["name", "Name"]).select("chem_code", "flag")


def drop_header_rows(
    df: DataFrame, key: str, header_values: Sequence[str]
) -> DataFrame:
    """Remove the second header row of a survey export, wherever it lands."""
    return df.where(~F.coalesce(F.col(f"`{key}`").isin(list(header_values)), F.lit(False)))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON list of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def harvest_links(pages: DataFrame, token: str, html: str = "html") -> DataFrame:
    """``(page_id, href, name)`` for links whose target contains ``token``;
    ``name`` is the last part of the target."""
    links = pages.where(F.col(html).contains(token)).select(
        "page_id", F.posexplode(link_targets(F.col(html))).alias("position", "href")
    )
    return links.where(F.col("href").contains(token)).select(
        "page_id",
        "position",
        "href",
        F.element_at(F.split("href", "/"), -1).alias("name"),
    )

"""Raw yearly reports to the full use fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.functions.dates import month_year
from arealytics.functions.numbers import clean_code, clean_numeric
from arealytics.functions.text import township_range
from arealytics.operators.geometry import points_within
from arealytics.operators.joins import lookup_join
from arealytics.operators.union import union_edges
from arealytics.session import pin
from arealytics.specs import CODE_BLANKS, CODES, MEASURE_BLANKS, MEASURES, REPORT_COLUMNS


def rename_keep(
    df: DataFrame, mapping: Mapping[str, str] = REPORT_COLUMNS, carry: Sequence[Column] = ()
) -> DataFrame:
    """Exactly the mapped columns, renamed, and those to ``carry`` along."""
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in mapping.items()], *carry)


def clean_columns(df: DataFrame, mode: str = "strict") -> DataFrame:
    return clean_code(
        clean_numeric(df, MEASURES, MEASURE_BLANKS, mode), CODES, CODE_BLANKS
    )


def section_meridians(
    centroids: DataFrame, townships: DataFrame, keys: DataFrame
) -> DataFrame:
    """``(CO_MTRS, Meridian)`` of sections whose centre lies in a meridian area.

    ``centroids`` is ``(point, x, y)``; ``townships`` an edge table whose parts
    ``keys`` (``id, Meridian``) merges into meridian areas.
    """
    areas = union_edges(
        townships, keys.withColumnRenamed("id", "_part"), "_part", "Meridian"
    )
    return points_within(centroids, areas).select(
        F.col("point").alias("CO_MTRS"), F.col("id").alias("Meridian")
    )


def attach_meridian(df: DataFrame, meridians: DataFrame) -> DataFrame:
    """Township text with its meridian; null when either is unknown.

    A section in two meridian areas would repeat its rows, as an equi-merge
    does.
    """
    # stored, so that the join is chosen by its real size
    sections = pin(meridians.select(F.col("CO_MTRS").alias("comtrs"), "Meridian"))
    return (
        lookup_join(df, sections, ["comtrs"], "left")
        .withColumn(
            "MeridianTownshipRange",
            F.concat(
                F.col("Meridian"), F.lit(" "), township_range(F.col("comtrs"))
            ),
        )
        .drop("Meridian")
    )


def clean_use(
    raw: DataFrame, meridians: DataFrame, mode: str = "strict", carry: Sequence[Column] = ()
) -> DataFrame:
    """The full cleaned fact.  ``raw`` is the union of all yearly reports with a
    date; everything but the section lookup is one projection.  ``carry`` names
    further columns that pass through."""
    df = clean_columns(rename_keep(raw, carry=carry), mode)
    df = df.withColumn("monthyear", month_year(F.col("date"))).drop("date")
    return attach_meridian(df, meridians)

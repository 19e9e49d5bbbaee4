"""Group summaries, all with partial (map-side) aggregation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from arealytics.functions.dates import year_of
from arealytics.operators.joins import lookup_join
from arealytics.operators.keys import in_ranges, with_offset
from arealytics.session import pin


def period_sums(fact: DataFrame, ids: Sequence[str], use: str) -> DataFrame:
    """Level one: pounds per id and month.  An all-null group sums to 0."""
    number = F.col(use).try_cast("double")
    return (
        fact.where(F.col(ids[-1]).isNotNull())
        .groupBy(*ids, "monthyear")
        .agg(F.coalesce(F.sum(number), F.lit(0.0)).alias("_lbs"))
    )


def period_stats(sums: DataFrame, ids: Sequence[str], use: str) -> DataFrame:
    """Level two: a group holds one row per month, so sets stay small.

    Totals take rows without a month along, the other figures do not; ids
    without any month drop out.
    """
    dated = F.col("monthyear").isNotNull()
    lbs = F.when(dated, F.col("_lbs"))
    years = F.collect_set(year_of(F.col("monthyear")))
    months = F.collect_set("monthyear")
    return (
        sums.groupBy(*ids)
        .agg(
            F.sum("_lbs").alias(use),
            F.sum(lbs).alias("_dated"),
            F.max(lbs).alias("monthly_high"),
            F.avg(lbs).alias("monthly_average"),
            F.array_sort(years).alias("years_used"),
            F.array_sort(months).alias("months_used"),
        )
        .where(F.size("months_used") > 0)
        .withColumn("yearly_average", F.col("_dated") / F.size("years_used"))
        .select(
            *ids,
            use,
            "yearly_average",
            "monthly_high",
            "monthly_average",
            "years_used",
            "months_used",
        )
    )


def use_stats(fact: DataFrame, id_column: str, use: str = "lbs_chm_used"):
    """Total, yearly and monthly figures and used periods per id."""
    return period_stats(period_sums(fact, [id_column], use), [id_column], use)


def file_year(df: DataFrame, file: str, year: str = "YEAR") -> DataFrame:
    """Most frequent year of each file, the smallest on a tie.  A file with no
    year at all is missing from the result."""
    counts = (
        df.where(F.col(year).isNotNull())
        .groupBy(file, F.col(year).cast("int").alias(year))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return counts.groupBy(file).agg(
        F.max_by(year, F.struct("_rows", -F.col(year))).alias(year)
    )


def assign_file_year(df: DataFrame, file: str, year: str = "YEAR") -> DataFrame:
    """Set the file's year on all of its rows; a file without one is an error."""
    found = pin(file_year(df, file, year))  # a row per file, by its real size
    joined = lookup_join(df.drop(year), found, [file], "left")
    return joined.withColumn(
        year,
        F.coalesce(
            F.col(year),
            F.raise_error(F.concat(F.lit("no year in file "), F.col(file))).cast(
                "int"
            ),
        ),
    )


def distinct_pair_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum of ``value`` over distinct (key, value) pairs."""
    return df.select(key, value).distinct().agg(F.sum(value).alias(value))


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float]
) -> list[float]:
    """Linear-interpolated quantiles, one number per probability.

    Values are counted first, so a value repeated without end is one row, and
    the distinct values are ranked by range partitioning.  No task holds the
    whole column, and one row of cut values leaves the executors.
    """
    counts = (
        df.select(F.col(column).alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranged = in_ranges(counts, ["_v"])
    rows = ranged.agg(F.sum("_n")).first()[0]
    if rows is None:
        return []
    exact = [(rows - 1) * p for p in probabilities]
    wanted = sorted({f(x) for x in exact for f in (math.floor, math.ceil)})
    within = Window.partitionBy("_part").orderBy("_place")  # one range at a time
    upto = with_offset(ranged, F.sum("_n")).withColumn(
        "_upto", F.col("_offset") + F.sum("_n").over(within)
    )
    found = upto.agg(
        *[
            F.min(F.when(F.col("_upto") > at, F.col("_v"))).alias(str(at))
            for at in wanted
        ]
    ).first()
    cuts = []
    for x in exact:
        low, high = found[str(math.floor(x))], found[str(math.ceil(x))]
        cuts.append(low + (high - low) * (x - math.floor(x)))
    return cuts


def quantile_bins(df: DataFrame, column: str, bins: int = 5) -> DataFrame:
    """Add ``bin`` 1..n by quantile of the non-zero values; 0 and null stay
    outside the scale (null bin)."""
    shown = F.col(column).isNotNull() & (F.col(column) != 0)
    cuts = exact_quantiles(
        df.where(shown), column, [i / bins for i in range(1, bins)]
    )
    number = F.lit(1)
    for cut in cuts:
        number = number + F.when(F.col(column) >= F.lit(cut), 1).otherwise(0)
    return df.withColumn("bin", F.when(shown, number).cast("int"))


def option_list(
    df: DataFrame, value: str, label: str | None = None, limit: int = 50
) -> DataFrame:
    """Distinct value/label pairs for a filter control, first ``limit`` shown."""
    label = label or value
    return (
        df.select(F.col(value).alias("value"), F.col(label).alias("label"))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy(F.col("label").asc_nulls_last(), F.col("value"))
        .limit(limit)
    )

"""Row filters, among them the dashboard's parameter filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F

from arealytics.functions.dates import year_of

NO_FILTER = "*"

# parameter -> column it filters; lists of values, '*' or [] for no filter
CHOICES = {
    "ai_class": "major_category",
    "ai_type": "ai_type",
    "ai_type_specific": "ai_type",
    "site": "site_code",
    "usetype": "usetype",
    "chemical": "chem_code",
    "product": "prodno",
    "county": "county_cd",
    "townshiprange": "MeridianTownshipRange",
    "schooldistrict": "FIPS",
    "tract": "GEOID",
}

# parameter -> column it bounds from below
MINIMUMS = {
    "pctblack": "Pct NH Black",
    "pcthispanic": "Pct Hispanic",
    "income": "Median HH Income",
}


def drop_null(
    df: DataFrame, column: str, observation: Observation | None = None
) -> DataFrame:
    """Rows with a value.  An observation counts the dropped rows in passing."""
    if observation is not None:
        df = df.observe(
            observation, F.count_if(F.col(column).isNull()).alias("dropped")
        )
    return df.where(F.col(column).isNotNull())


def not_equal_or_null(column: Column, value: Any) -> Column:
    """``!=`` under which null passes."""
    return ~column.eqNullSafe(F.lit(value))


def choice(column: Column, wanted: Any) -> Column | None:
    """Predicate for one filter control; None when it does not filter."""
    if wanted is None or wanted == NO_FILTER:
        return None
    values = [wanted] if isinstance(wanted, str) else list(wanted)
    if not values or NO_FILTER in values:
        return None
    return column.isin(values)


def usage_filter(
    df: DataFrame,
    params: Mapping[str, Any],
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Apply the dashboard's parameters as plain predicates.

    ``start`` and ``end`` are months, both included.  ``columns`` overrides the
    column a parameter works on.  Every predicate compares a stored column with
    literals, so all of them reach the parquet scan.
    """
    columns = {**CHOICES, **MINIMUMS, **(columns or {})}
    unknown = set(params) - set(columns) - {"start", "end"}
    if unknown:
        raise ValueError(f"unknown filter parameters: {sorted(unknown)}")
    predicates: list[Column] = []
    if params.get("start"):
        predicates.append(F.col("monthyear") >= params["start"])
    if params.get("end"):
        predicates.append(F.col("monthyear") <= params["end"])
    for name in CHOICES:
        if name in params:
            predicate = choice(F.col(f"`{columns[name]}`"), params[name])
            if predicate is not None:
                predicates.append(predicate)
    for name in MINIMUMS:
        bound = params.get(name)
        if bound:  # a slider at 0 does not filter
            predicates.append(F.col(f"`{columns[name]}`") >= bound)
    for predicate in predicates:
        df = df.where(predicate)
    return df


def use_over_time(
    fact: DataFrame,
    by: str,
    period: str = "month",
    params: Mapping[str, Any] | None = None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Pounds by period and one grouping column, for the time-series pages."""
    if period not in ("month", "year"):
        raise ValueError(f"unknown period {period!r}")
    date = F.col("monthyear") if period == "month" else year_of(F.col("monthyear"))
    return (
        usage_filter(fact, params or {}, columns)
        .groupBy(date.alias("date"), by)
        .agg(F.sum("lbs_chm_used").alias("lbs_chm_used"))
    )


def use_by_area(
    fact: DataFrame,
    areas: DataFrame,
    area_id: str,
    params: Mapping[str, Any] | None = None,
    columns: Mapping[str, str] | None = None,
    measures: Sequence[str] = ("lbs_chm_used", "lbs_prd_used"),
) -> DataFrame:
    """Pounds by area for the map pages; areas without use keep null pounds.

    Share and income minimums look at the areas, everything else at the use.
    The fact is reduced to one row per area before it meets the area table.
    """
    params = dict(params or {})
    of_area = {k: params.pop(k) for k in list(params) if k in MINIMUMS}
    sums = (
        usage_filter(fact, params, columns)
        .where(F.col(area_id).isNotNull())
        .groupBy(area_id)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    return usage_filter(areas, of_area, columns).join(sums, area_id, "left")

"""Demographic tables per geographic level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.functions.numbers import guarded_share, share
from arealytics.functions.text import display_name
from arealytics.operators.joins import fits_broadcast, lookup_join
from arealytics.plans.units import compare_totals
from arealytics.specs import (
    COUNTS,
    EMPLOYED,
    FARMING,
    GROUPS,
    INCOME,
    NO_DISTRICT,
    NO_HIGH_SCHOOL,
    OLDER_COUNTS,
    OLDER_SHARES,
    OVER_25,
    POPULATION,
    POPULATION_TOTALS,
    SHORT_NAMES,
)


_COUNT, _RATIO = "decimal(20,3)", "decimal(16,12)"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def full_names(df: DataFrame) -> DataFrame:
    """Short survey column names to the full ones."""
    return df.withColumnsRenamed(SHORT_NAMES)


def standard_demography(
    df: DataFrame, area_id: str = "FIPS", also_keep: Sequence[str] = ()
) -> DataFrame:
    """Id, income, population by group with shares, schooling and farm work."""
    groups = []
    for name, source in GROUPS:
        groups.append(_c(source).alias(f"Pop {name}"))
        groups.append(share(_c(source), _c(POPULATION), 3).alias(f"Pct {name}"))
    return df.select(
        area_id,
        F.bround(_c(INCOME), 0).alias("Median HH Income"),
        _c(POPULATION).alias("Pop Total"),
        *groups,
        share(_c(NO_HIGH_SCHOOL), _c(OVER_25), 3).alias("Pct No High School"),
        share(_c(FARMING), _c(EMPLOYED), 3).alias("Pct Agriculture"),
        *also_keep,
    )


def guarded_demography(df: DataFrame, area_id: str) -> DataFrame:
    """Older form: income and whole-percent shares, 0 for an empty area."""
    return df.select(
        area_id,
        _c(INCOME).alias("median_hh"),
        *[
            guarded_share(_c(source), _c(POPULATION)).alias(name)
            for name, source in OLDER_SHARES
        ],
    )


def _unit(demography: DataFrame, geo: DataFrame, area_id: str) -> DataFrame:
    return demography.join(geo, area_id, "inner").distinct()


def tract_demography(survey: DataFrame, geo: DataFrame) -> DataFrame:
    """Tracts: figures, land and water area, display name."""
    named = geo.select(
        F.col("GEOID").alias("FIPS"),
        "GEOID",
        "ALAND",
        "AWATER",
        display_name(F.col("NAMELSAD"), F.col("NAMELSADCO")).alias("Area Name"),
    )
    return _unit(standard_demography(survey), named, "FIPS")


def county_demography(survey: DataFrame, geo: DataFrame, ordinal: str) -> DataFrame:
    """Counties, joined on the survey row's stored position."""
    figures = standard_demography(
        full_names(survey).withColumn("county_cd", _c(ordinal).cast("long")),
        also_keep=["Area Name", "county_cd"],
    )
    areas = geo.select(
        F.col("county_cd").cast("long").alias("county_cd"),
        F.col("ALAND").cast("long").alias("ALAND"),
        F.col("AWATER").cast("long").alias("AWATER"),
    )
    return _unit(figures, areas, "county_cd").drop("county_cd")


def school_demography(survey: DataFrame, geo: DataFrame) -> DataFrame:
    figures = standard_demography(full_names(survey), also_keep=["Area Name"])
    return _unit(figures, geo.select("FIPS", "ALAND", "AWATER"), "FIPS")


def zip_demography(survey: DataFrame, geo: DataFrame) -> DataFrame:
    areas = geo.select(
        F.col("ZCTA5CE20").alias("GEOID"),
        F.col("ALAND20").alias("ALAND"),
        F.col("AWATER20").alias("AWATER"),
    )
    return _unit(standard_demography(survey, "GEOID"), areas, "GEOID")


def _weighted(
    pairs: DataFrame,
    tracts: DataFrame,
    area_id: str,
    tract_id: str,
    counts: Sequence[str],
    ignore_missing_income: bool,
    ratio: str,
) -> DataFrame:
    """Counts and income times ratio, summed per area in one aggregate: exactly,
    counts with three and ratios with twelve digits after the point."""
    known = tracts.select(F.col(tract_id).alias("_tract"), *map(_c, [*counts, INCOME]))
    shared = lookup_join(
        pairs.select(area_id, F.col("_tract"), ratio),
        known,
        ["_tract"],
        "left",
        fits_broadcast(tracts),
    )
    # fixed point: a sum at exactly a half must not depend on the rows' order
    r = F.coalesce(_c(ratio).cast(_RATIO), F.lit(0).cast(_RATIO))
    income_weight = (
        F.when(_c(INCOME).isNotNull(), r) if ignore_missing_income else r
    )
    # a null count or income adds 0, as does a null ratio
    sums = [
        F.bround(F.coalesce(F.sum(_c(c).cast(_COUNT) * r), F.lit(0)), 0).cast("long").alias(c)
        for c in [*counts, INCOME]
    ]
    return shared.groupBy(area_id).agg(
        *sums, F.sum(income_weight).cast("double").alias("_weight")
    )


def area_demography(
    areas: DataFrame,
    crosswalk: DataFrame,
    tracts: DataFrame,
    area_id: str,
    crosswalk_tract: str = "GEOID",
    tract_id: str = "FIPS",
    ratio: str = "AREA_RATIO",
    ignore_missing_income: bool = False,
) -> DataFrame:
    """Demography of areas that hold parts of tracts.

    ``areas`` is ``(area_id, ALAND)``, ``crosswalk`` ``(area_id, tract,
    ratio)``.  Income is the weighted sum over the sum of weights; by default a
    tract without income counts as 0.
    """
    pairs = crosswalk.withColumnRenamed(crosswalk_tract, "_tract").join(
        areas.select(area_id), area_id, "left_semi"
    )
    sums = _weighted(
        pairs, tracts, area_id, tract_id, COUNTS, ignore_missing_income, ratio
    ).withColumn(INCOME, F.try_divide(_c(INCOME), F.col("_weight")))
    return areas.join(standard_demography(sums, area_id), area_id, "inner")


def area_demography_guarded(
    crosswalk: DataFrame,
    tracts: DataFrame,
    area_id: str,
    crosswalk_tract: str = "GEOID",
    tract_id: str = "FIPS",
    ratio: str = "AREA_RATIO",
) -> DataFrame:
    """Older form: seven counts and the weighted (undivided) income sum."""
    pairs = crosswalk.withColumnRenamed(crosswalk_tract, "_tract")
    sums = _weighted(pairs, tracts, area_id, tract_id, OLDER_COUNTS, False, ratio)
    return guarded_demography(sums, area_id)


def population_totals(df: DataFrame) -> DataFrame:
    return df.agg(*[F.sum(_c(column)).alias(key) for key, column in POPULATION_TOTALS])


def population_reconcile(tract: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Compare population totals of other levels with the tracts', as rows."""
    keys = [key for key, _ in POPULATION_TOTALS]
    return compare_totals(
        population_totals(tract),
        {title: (population_totals(df), keys) for title, df in others.items()},
    )


def district_survey(elementary: DataFrame, unified: DataFrame) -> DataFrame:
    """Both district layers as one, tagged by type; the row of areas without a
    district goes and ids lose their state prefix."""
    tagged = [
        df.where(F.col("FIPS") != NO_DISTRICT).withColumn("District Type", F.lit(kind))
        for df, kind in ((elementary, "Elementary"), (unified, "Unified"))
    ]
    both = tagged[0].unionByName(tagged[1])
    return both.withColumn("FIPS", F.expr("substring(FIPS, 3)"))

"""Fact tables per geographic level, and their reconciliation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.functions.numbers import coerce_numeric, percent_difference
from arealytics.operators.crosswalk import apportion
from arealytics.operators.joins import lookup_join, renamed_lookup
from arealytics.operators.keys import dense_index, use_id
from arealytics.session import give_back, pin
from arealytics.specs import (
    AG,
    COUNTY,
    SCHOOL,
    SECTION,
    TOWNSHIP,
    TRACT,
    UNIT_NUMBERS,
    ZIP,
    Derive,
    UnitSpec,
)

__all__ = [
    "apply_derived",
    "apportion",
    "compare_totals",
    "county_fact",
    "enrich",
    "fact_with_demography",
    "reconcile",
    "totals",
    "unit_fact",
    "unit_tables",
]


def enrich(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Fact with application key and chemical categories.

    Categories are deduplicated first, so a row matches at most one.
    """
    keyed = fact.withColumn("use_id", use_id()).drop("use_number")
    known = pin(categories.distinct())  # the join is chosen by its real size
    return lookup_join(keyed, known, ["chem_code"], "left")


def _usetypes(fact: DataFrame, spec: UnitSpec, apply_usetype: bool) -> DataFrame:
    if apply_usetype and spec.usetypes is not None:
        return fact.where(F.col("usetype").isin(list(spec.usetypes)))
    return fact


def _fill_text(df: DataFrame) -> DataFrame:
    """Missing text becomes ''.  The application key keeps its null, which
    stands for the one shared number after the last."""
    return df.fillna("", [c for c in df.columns if c != "use_id"])


def unit_fact(fact: DataFrame, spec: UnitSpec, apply_usetype: bool = False) -> DataFrame:
    """Township or section table: missing text becomes '', numbers stay
    numbers, the long key becomes a dense integer."""
    kept = _fill_text(_usetypes(fact, spec, apply_usetype).drop(*spec.drop))
    return coerce_numeric(dense_index(kept, ["use_id"]), UNIT_NUMBERS)


def county_fact(
    fact: DataFrame,
    fips: DataFrame,
    spec: UnitSpec = COUNTY,
    apply_usetype: bool = False,
) -> DataFrame:
    """County table: the county code looked up to its area id."""
    codes = fips.select(F.col("DPR_ID").cast("string").alias("DPR_ID"), spec.area_id)
    kept = _fill_text(_usetypes(fact, spec, apply_usetype).drop(*spec.drop))
    joined = renamed_lookup(kept, codes, {"county_cd": "DPR_ID"})
    return coerce_numeric(dense_index(joined, ["use_id"]), UNIT_NUMBERS)


def unit_tables(
    fact: DataFrame,
    categories: DataFrame,
    crosswalks: Mapping[str, DataFrame],
    fips: DataFrame,
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The enriched fact and all unit tables derived from it.

    ``crosswalks`` has one entry per area level (``tract``, ``school``,
    ``zip``).  The enriched fact is written once and read by every level.
    ``columns`` of the fact are all that the tables carry, where given.
    """
    base = pin(enrich(fact, categories))
    rows = base if columns is None else base.select(*columns)
    return base, dict(unit_levels(rows, crosswalks, fips))


def unit_levels(
    rows: DataFrame, crosswalks: Mapping[str, DataFrame], fips: DataFrame
) -> Iterator[tuple[str, DataFrame]]:
    """The unit tables by name, each made when it is asked for."""
    for spec in (TRACT, SCHOOL, ZIP):
        if spec.name in crosswalks:
            yield spec.name, apportion(rows, crosswalks[spec.name], spec)
    yield "county", county_fact(rows, fips)
    yield "township", unit_fact(rows, TOWNSHIP)
    yield "section", unit_fact(rows, SECTION)


# what every level is derived from and its pounds are summed by.  The tables are
# stored when their keys are numbered, so that the optimizer cannot drop the rest
RECONCILED = (
    "use_id",
    "usetype",
    "comtrs",
    "county_cd",
    "MeridianTownshipRange",
    *UNIT_NUMBERS,
)

# levels that hold farm use only, or are checked for it only
AG_ONLY = frozenset({"tract", "school", "zip", "township"})


def fact_with_demography(
    fact: DataFrame, demography: DataFrame, area_id: str, demography_id: str
) -> DataFrame:
    """Older form of a unit table: area figures repeated on every fact row."""
    return renamed_lookup(fact, demography, {area_id: demography_id})


def totals(fact: DataFrame, key: str) -> DataFrame:
    """One row: chemical and product pounds, all and farm use only.

    A product's pounds repeat on the row of each of its chemicals, so they are
    summed over distinct (application, pounds) pairs.  One aggregate by that
    pair serves all four figures.
    """
    ag = F.col("usetype") == AG
    pairs = fact.groupBy(key, "lbs_prd_used").agg(
        F.sum("lbs_chm_used").alias("_chm"),
        F.sum(F.when(ag, F.col("lbs_chm_used"))).alias("_chm_ag"),
        F.max(F.coalesce(ag, F.lit(False))).alias("_ag"),
    )
    return pairs.agg(
        F.coalesce(F.sum("_chm"), F.lit(0.0)).alias("chm"),
        F.coalesce(F.sum("lbs_prd_used"), F.lit(0.0)).alias("prd"),
        F.coalesce(F.sum("_chm_ag"), F.lit(0.0)).alias("chm_ag"),
        F.coalesce(
            F.sum(F.when(F.col("_ag"), F.col("lbs_prd_used"))), F.lit(0.0)
        ).alias("prd_ag"),
    )


def compare_totals(
    base: DataFrame, derived: dict[str, tuple[DataFrame, list[str]]]
) -> DataFrame:
    """``(title, measure, base, derived, diff, pct)`` from one-row frames."""

    def long(df: DataFrame, measures: list[str]) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(
                    F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("v")
                )
                for m in measures
            ]
        )
        return df.select(F.inline(pairs))

    parts = []
    for title, (frame, measures) in derived.items():
        named = F.lit(title).alias("title")
        parts.append(
            long(base, measures).select(
                named, "measure", F.col("v").alias("b"), F.lit(None).cast("double").alias("d")
            )
        )
        parts.append(
            long(frame, measures).select(
                named, "measure", F.lit(None).cast("double").alias("b"), F.col("v").alias("d")
            )
        )
    both = reduce(DataFrame.unionByName, parts)
    one = both.groupBy("title", "measure").agg(
        F.max("b").alias("base"), F.max("d").alias("derived")
    )
    return one.select(
        "title",
        "measure",
        "base",
        "derived",
        (F.col("base") - F.col("derived")).alias("diff"),
        percent_difference(F.col("base"), F.col("derived")).alias("pct"),
    )


def reconcile(
    base: DataFrame,
    derived: Mapping[str, DataFrame] | Iterator[tuple[str, DataFrame]],
    ag_only: frozenset[str] = frozenset(),
) -> DataFrame:
    """Compare each unit table's pounds with the base fact's, as rows.

    Every level is summed in a job of its own and its one row stored: together
    they would be a plan too large for a small driver, with the base in it once
    per level.  Levels that come one by one are given back when they are summed, so
    that only one is stored at a time.
    """
    every = ["chm", "prd", "chm_ag", "prd_ag"]
    given = isinstance(derived, Mapping)
    frames = {}
    for title, df in derived.items() if given else derived:
        frames[title] = pin(totals(df, "use_index")), every[2:] if title in ag_only else every
        if not given:
            give_back(df)
    return compare_totals(pin(totals(base, "use_id")), frames)


def apply_derived(df: DataFrame, columns: dict[str, Derive]) -> DataFrame:
    """User columns from a spec: each value takes the frame, gives a column."""
    derived: dict[str, Column] = {name: make(df) for name, make in columns.items()}
    return df.withColumns(derived)

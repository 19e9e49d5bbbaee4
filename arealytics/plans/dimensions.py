"""Code tables with use statistics, and chemical categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from arealytics.functions.numbers import coerce_numeric
from arealytics.functions.text import label_string, title_case
from arealytics.operators.aggregates import period_stats, period_sums, use_stats
from arealytics.operators.filters import not_equal_or_null
from arealytics.operators.joins import fits_broadcast, keep_known
from arealytics.operators.keys import first_row_id
from arealytics.session import pin
from arealytics.specs import (
    CLASSES,
    EXCLUDED_TYPE,
    HEALTH,
    RESTRICTED,
    DimensionSpec,
    Label,
)


def label_table(spark: SparkSession, labels: Sequence[Label]) -> DataFrame:
    return spark.createDataFrame(
        [(x.label, x.id) for x in labels], "label string, id string"
    )


def code_table(
    codes: DataFrame, fact: DataFrame, spec: DimensionSpec, active_only: bool = True
) -> DataFrame:
    """A code table cut to the ids in use, with its output columns."""
    codes = codes.withColumn(spec.file_id, F.col(spec.file_id).cast("string"))
    if active_only:
        codes = keep_known(codes, spec.file_id, fact, spec.fact_id)
    if spec.columns:
        codes = codes.select(*spec.columns)
    return codes.withColumnsRenamed(dict(spec.rename))


def _labeled(codes: DataFrame, stats: DataFrame, spec: DimensionSpec) -> DataFrame:
    stats = stats.drop("years_used", "months_used")
    if spec.out_id == spec.fact_id:
        joined = codes.join(stats, spec.fact_id, "inner")
    else:  # both names stay
        joined = codes.join(
            stats, codes[spec.out_id] == stats[spec.fact_id], "inner"
        )
    return joined.orderBy(F.col(spec.out_label).asc_nulls_last())


def dimension(
    fact: DataFrame, codes: DataFrame, spec: DimensionSpec, active_only: bool = True
) -> DataFrame:
    """One code table with its use statistics, sorted by name.

    The inner join with the statistics keeps only ids in use, so the fact is
    read once whatever ``active_only`` says.
    """
    return _labeled(
        code_table(codes, fact, spec, active_only=False),
        use_stats(fact, spec.fact_id),
        spec,
    )


def month_sums(fact: DataFrame, specs: Sequence[DimensionSpec]) -> DataFrame:
    """``(table, id, monthyear, _lbs)``: pounds per month and id of every code
    table, from a single pass over the fact."""
    ids = F.explode(
        F.array(
            *[
                F.struct(F.lit(s.name).alias("table"), F.col(s.fact_id).alias("id"))
                for s in specs
            ]
        )
    ).alias("_d")
    spread = fact.select(ids, "lbs_chm_used", "monthyear").select(
        "_d.table", "_d.id", "lbs_chm_used", "monthyear"
    )
    return period_sums(spread, ["table", "id"], "lbs_chm_used")


def tables_of_months(
    sums: DataFrame,
    codes: dict[str, DataFrame],
    specs: Sequence[DimensionSpec],
    active_only: bool = True,
) -> dict[str, DataFrame]:
    """Code tables with the statistics of stored month sums."""
    out = {}
    for spec in specs:
        own = sums.where(F.col("table") == spec.name).withColumnRenamed("id", spec.fact_id)
        stats = period_stats(own, [spec.fact_id], "lbs_chm_used")
        table = code_table(codes[spec.name], own, spec, active_only)
        out[spec.name] = _labeled(table, stats, spec)
    return out


def dimensions(
    fact: DataFrame,
    codes: dict[str, DataFrame],
    specs: Sequence[DimensionSpec],
    active_only: bool = True,
) -> dict[str, DataFrame]:
    """Several code tables from a single pass over the fact.

    Every row goes to each dimension's month sums in one partial aggregate; the
    pinned sums (one row per id and month) serve all tables.
    """
    return tables_of_months(pin(month_sums(fact, specs)), codes, specs, active_only)


def restricted_codes(materials: DataFrame) -> DataFrame:
    """``(chem_code, Restricted Material)`` of the readable codes in the list."""
    codes = coerce_numeric(materials, ["chem_code"]).dropna(subset=["chem_code"])
    return codes.select(
        F.col("chem_code").cast("long").cast("string").alias("chem_code"),
        F.lit("Y").alias(RESTRICTED),
    )


def flag_restricted(flags: DataFrame, materials: DataFrame) -> DataFrame:
    """Left join; a code listed twice repeats its row until the final distinct."""
    flags = flags.withColumn("CHEM_CODE", F.col("CHEM_CODE").cast("string"))
    return flags.withColumnsRenamed(
        {"CHEM_CODE": "chem_code", "AI_TYPE": "ai_type"}
    ).join(restricted_codes(materials), "chem_code", "left")


def type_codes(flags: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """``(ai_type, ai_type_ID)``: source position of each type's first row."""
    return first_row_id(
        flags.where(not_equal_or_null(F.col("ai_type"), EXCLUDED_TYPE)),
        "ai_type",
        ordinal,
    )


def use_type_codes(flags: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The published type table, names in title case."""
    return type_codes(flags, ordinal).select(
        title_case(F.col("ai_type")).alias("ai_type"), "ai_type_ID"
    ).distinct()


def categories(flags: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """``(chem_code, major_category, ai_type, health)`` per chemical, all text.

    ``flags`` comes from ``flag_restricted``, cut to the chemicals in use with
    ``keep_known``.  The excluded type has no code and drops out; a missing
    type is a type of its own.
    """
    codes = type_codes(flags, ordinal).withColumnRenamed("ai_type", "_type")
    # one row per ingredient type, at most one per chemical
    if fits_broadcast(flags):
        codes = F.broadcast(codes)
    return (
        flags.join(codes, flags["ai_type"].eqNullSafe(codes["_type"]), "inner")
        .select(
            "chem_code",
            label_string(CLASSES).alias("major_category"),
            F.col("ai_type_ID").cast("string").alias("ai_type"),
            label_string(HEALTH).alias("health"),
        )
        .distinct()
    )

"""Name -> (Spark query, SQL)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from arealytics.catalog.views import Inputs, compose
from arealytics.session import apply_settings

Build = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}
NAMED: dict[str, str] = {}  # subqueries the SQL texts share


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Inputs(apply_settings(spark), folder))


def sql_of(name: str) -> str:
    return compose(SQL[name], NAMED)


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round at the query's edge: sums of doubles depend on their order."""
    return df.withColumns(
        {c: F.round(F.col(f"`{c}`"), n) for c, n in digits.items()}
    )

"""Domain-shaped views over the test tables.

A view is a projection written once in the SQL both engines share; where they
differ an entry is a pair (Spark, DuckDB).  The views only shape inputs, the
operators under test are written separately for each engine.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arealytics.sources.files import spread
from arealytics.specs import (
    AIAN,
    ASIAN,
    BLACK,
    EMPLOYED,
    FARMING,
    FLAGS,
    HISPANIC,
    INCOME,
    NHPI,
    NO_HIGH_SCHOOL,
    OVER_25,
    POPULATION,
    SHORT_NAMES,
    WHITE,
)

Expr = str | tuple[str, str]


@dataclass(frozen=True)
class View:
    source: str
    columns: Mapping[str, Expr]
    where: str | None = None
    expand: tuple[str, str] | None = None  # extra column, one row per value


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS STRING), {n}, '0')"


def div(x: str, n: int) -> str:
    return f"CAST(floor(({x}) / {n}) AS BIGINT)"


def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"


def section_code(key: str) -> str:
    """Eleven characters: county, meridian, township, range, section."""
    return (
        f"{pad(f'{key} % 25 + 1', 2)} || 'M' || {pad(f'{div(key, 36)} % 100', 2)} || 'N'"
        f" || {pad(f'{div(key, 3600)} % 100', 2)} || 'E' || {pad(f'{key} % 36 + 1', 2)}"
    )


def tract_code(key: str) -> str:
    return f"'06' || {pad(key, 9)}"


_LATER = ("add_months(l_shipdate, 240)", "l_shipdate + INTERVAL 20 YEAR")
_DAY = (
    f"date_format({_LATER[0]}, 'dd-MMM-yy')",
    f"strftime({_LATER[1]}, '%d-%b-%y')",
)


def _date(day: str) -> str:
    return (
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL"
        f" WHEN l_orderkey % 89 = 0 THEN {day} ELSE upper({day}) END"
    )


_RAW = {
    "YEAR": "CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(year(l_shipdate) + 20 AS INT) END",
    "_file": f"'udc' || {pad('l_suppkey % 20', 2)}",
    "DATE": (_date(_DAY[0]), _date(_DAY[1])),
    "COMTRS": "CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN '10M10'"
    f" ELSE {section_code('l_suppkey')} END",
    "USE_NUMBER": "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE"
    f" {text('l_suppkey * 10 + l_orderkey % 5')} END",
    "ADJUVANT": "CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END",
    "AERIAL_GROUND_INDICATOR": "CASE WHEN l_linestatus = 'O' THEN 'G' WHEN l_quantity > 40 THEN NULL ELSE 'A' END",
    "AG_NONAG": "CASE WHEN l_returnflag IN ('A', 'N') THEN 'AG' ELSE 'NONAG' END",
    "POUNDS_CHEMICAL_APPLIED": "CASE WHEN l_orderkey % 61 = 0 THEN NULL WHEN l_orderkey % 67 = 0 THEN 'MARCH'"
    f" WHEN l_orderkey % 71 = 0 THEN 'nan' ELSE {cents('l_quantity')} END",
    "POUNDS_PRODUCT_APPLIED": "CASE WHEN l_orderkey % 73 = 0 THEN 'ACRES' ELSE"
    f" {cents('(l_suppkey % 7 + 1) * 12.25 + (l_orderkey % 5) * 100')} END",
    "AMOUNT_PLANTED": f"CASE WHEN l_orderkey % 79 = 0 THEN NULL ELSE {cents('l_discount * 100')} END",
    "PRODUCT_CHEMICAL_PERCENT": cents("l_tax * 100"),
    "CHEMICAL_CODE": "CASE WHEN l_orderkey % 53 = 0 THEN 'GA' WHEN l_orderkey % 59 = 0 THEN NULL"
    f" WHEN l_partkey % 7 = 0 THEN {text('l_partkey')} || '.0' WHEN l_partkey % 11 = 0 THEN {text('l_partkey')} || '.7'"
    f" ELSE {text('l_partkey')} END",
    "COUNTY_CODE": text("l_suppkey % 25 + 1"),
    "PRODUCT_NUMBER": text("l_partkey % 500"),
    "SITE_CODE": text("l_suppkey"),
}

_NATION_COUNTS = "c_custkey % 37 = 0"


def _people(expr: str) -> str:
    return f"CASE WHEN {_NATION_COUNTS} THEN 0 ELSE {expr} END"


_P = "(1000 + c_custkey * 7 % 5000)"

_DEMOGRAPHY = {
    POPULATION: _people(_P),
    HISPANIC: _people(f"{div(f'{_P} * (c_custkey % 5)', 20)}"),
    BLACK: _people(f"{div(f'{_P} * (c_custkey % 7)', 50)}"),
    WHITE: _people(f"{div(f'{_P} * (c_custkey % 3)', 10)}"),
    ASIAN: _people(f"{div(f'{_P} * (c_custkey % 4)', 30)}"),
    AIAN: _people(f"{div(f'{_P} * (c_custkey % 2)', 90)}"),
    NHPI: _people(f"{div(f'{_P} * (c_custkey % 9)', 200)}"),
    NO_HIGH_SCHOOL: _people(f"{div(f'{_P} * (c_custkey % 6)', 40)}"),
    OVER_25: _people(f"{div(f'{_P} * 2', 3)}"),
    FARMING: _people(f"{div(f'{_P} * (c_custkey % 8)', 60)}"),
    EMPLOYED: _people(f"{div(f'{_P}', 2)}"),
    INCOME: "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_acctbal * 10 + 30000 AS DOUBLE) END",
}
_LONG = {k: f"CAST({v} AS BIGINT)" for k, v in _DEMOGRAPHY.items() if k != INCOME} | {
    INCOME: _DEMOGRAPHY[INCOME]
}
_SHORT = {full: short for short, full in SHORT_NAMES.items()}
_DISTRICT = {
    "FIPS": f"CASE WHEN c_custkey % 10 = 0 THEN '0699999' ELSE '06' || {pad('c_custkey', 5)} END",
    "Area Name": "c_name",
} | {_SHORT.get(k, k): v for k, v in _LONG.items()}

_RATIO = (
    "CASE s_suppkey % 4 WHEN 0 THEN (CASE k WHEN 1 THEN 96e-2 WHEN 2 THEN 3e-2 ELSE 1e-2 END)"
    " WHEN 1 THEN (CASE k WHEN 1 THEN 95e-2 ELSE 25e-3 END)"
    " WHEN 2 THEN (CASE k WHEN 1 THEN 5e-1 WHEN 2 THEN 3e-1 ELSE 1999e-4 END)"
    " ELSE 0e0 END"
)

_SHARE = (
    "CASE s_suppkey % 3 WHEN 0 THEN 1e0 WHEN 1 THEN (CASE k WHEN 1 THEN 25e-2 ELSE 75e-2 END)"
    " ELSE (CASE k WHEN 1 THEN 5e-1 WHEN 2 THEN 3e-1 ELSE 2e-1 END) END"
)

VIEWS: dict[str, View] = {
    "use_raw": View("lineitem", _RAW),
    "section_meridian": View(
        "supplier",
        {
            "CO_MTRS": section_code("s_suppkey"),
            "Meridian": "CASE s_suppkey % 3 WHEN 0 THEN 'MDM' WHEN 1 THEN 'SBM' ELSE 'HBM' END",
        },
        where="s_suppkey % 17 <> 0",
    ),
    "section_xwalk": View(
        "supplier",
        {
            "CO_MTRS": section_code("s_suppkey"),
            "GEOID": tract_code("(s_suppkey * 15 + k * 4)"),
            "FIPS": pad("(s_suppkey + k * 7) % 50", 5),
            "ZCTA5CE20": f"'9' || {pad('(s_suppkey + k * 3) % 40', 4)}",
            "AREA_RATIO": _SHARE,
        },
        where="s_suppkey % 13 <> 0",
        expand=("explode(sequence(1, CAST(1 + s_suppkey % 3 AS INT)))", "unnest(range(1, 2 + s_suppkey % 3))"),
    ),
    "section_ratio": View(
        "supplier",
        {
            "CO_MTRS": section_code("s_suppkey"),
            "GEOID": tract_code("(s_suppkey * 15 + k * 4)"),
            "AREA_RATIO": _RATIO,
        },
        expand=("explode(sequence(1, 3))", "unnest(range(1, 4))"),
    ),
    "chem_flags": View(
        "part",
        {
            "ordinal": "p_partkey",
            "CHEM_CODE": text("p_partkey"),
            "AI_TYPE": "CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_type = 'PROMO' THEN 'ADJUVANT'"
            " WHEN p_type = 'SMALL' THEN 'SMALL/herb-o2x' ELSE p_type END",
        }
        | {
            flag: f"CASE (p_partkey * {i + 3} + p_size) % 11 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END"
            for i, flag in enumerate(FLAGS)
        },
    ),
    "restricted": View(
        "part",
        {
            "name": "p_name",
            "chem_code": f"CASE WHEN p_partkey % 29 = 0 THEN {text('p_partkey')} || '.0' ELSE 'various' END",
        },
        where="p_partkey % 29 = 0 OR p_partkey % 31 = 0",
        expand=(
            "explode(sequence(1, CAST(CASE WHEN p_partkey % 58 = 0 THEN 2 ELSE 1 END AS INT)))",
            "unnest(range(1, CASE WHEN p_partkey % 58 = 0 THEN 3 ELSE 2 END))",
        ),
    ),
    "chemical": View(
        "part",
        {"chem_code": text("p_partkey"), "chemname": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_name END", "casno": "p_brand"},
        where="p_partkey % 19 <> 0",
    ),
    "site": View("supplier", {"site_code": text("s_suppkey"), "site_name": "s_name"}),
    "product": View(
        "part", {"prodno": text("p_partkey"), "product_name": "p_brand || ' ' || p_name"}
    ),
    "county_xwalk": View(
        "nation",
        {"DPR_ID": text("n_nationkey + 1"), "FIPS": f"'06' || {pad('n_nationkey * 2 + 1', 3)}"},
        where="n_nationkey % 9 <> 8",
    ),
    "tract_survey": View(
        "customer", {"FIPS": tract_code("c_custkey")} | _LONG
    ),
    "tract_geo": View(
        "customer",
        {
            "GEOID": tract_code("c_custkey"),
            "NAMELSAD": f"'Census Tract ' || {text('c_custkey')}",
            "NAMELSADCO": f"'County ' || {text('c_nationkey')}",
            "ALAND": "c_custkey * 1000 + 17",
            "AWATER": "c_custkey % 100",
        },
        where="c_custkey % 21 <> 0",
    ),
    "county_survey": View(
        "customer",
        {"ordinal": "c_custkey", "FIPS": f"'06' || {pad('c_custkey', 6)}", "Area Name": "c_name"}
        | {_SHORT.get(k, k): v for k, v in _LONG.items()},
    ),
    "county_geo": View(
        "customer",
        {"county_cd": text("c_custkey"), "NAME": "c_name", "ALAND": text("c_custkey * 3"), "AWATER": text("c_custkey % 13")},
        where="c_custkey % 2 = 0",
    ),
    "elementary": View("customer", _DISTRICT, where="c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE')"),
    "unified": View("customer", _DISTRICT, where="c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')"),
    "school_geo": View(
        "customer",
        {"FIPS": f"'06' || {pad('c_custkey', 5)}", "ALAND": "c_custkey * 5", "AWATER": "c_custkey % 3"},
        where="c_custkey % 9 <> 4",  # a lookup with gaps
    ),
    "zip_survey": View("customer", {"GEOID": pad("c_custkey % 700", 5)} | _LONG),
    "zip_geo": View(
        "customer",
        {"ZCTA5CE20": pad("c_custkey", 5), "ALAND20": "c_custkey * 7", "AWATER20": "c_custkey % 5"},
        where="c_custkey % 2 = 1",
    ),
    "section_area": View(
        "supplier",
        {"comtrs": section_code("s_suppkey"), "ALAND": "CAST(s_suppkey * 10 + 1 AS DOUBLE)"},
        where="s_suppkey % 10 <> 3",
    ),
    "zip_county": View(
        "customer",
        {
            "ZIP": text("c_custkey * 11 % 99999"),
            "COUNTY": text("CASE WHEN c_nationkey % 3 = 0 THEN 6000 + c_nationkey ELSE 32000 + c_nationkey END"),
        },
    ),
    "zip_area": View("supplier", {"ZCTA5CE20": pad("s_suppkey * 11", 5), "name": "s_name"}),
    "old_use": View(
        "lineitem",
        {
            "use_no": "l_orderkey",
            "applic_dt": (
                "CASE WHEN l_orderkey % 47 = 0 THEN 'nan' ELSE date_format(add_months(l_shipdate, 240), 'MM/dd/yyyy') END",
                "CASE WHEN l_orderkey % 47 = 0 THEN 'nan' ELSE strftime(l_shipdate + INTERVAL 20 YEAR, '%m/%d/%Y') END",
            ),
            "comtrs": f"CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE {section_code('l_suppkey')} END",
            "county_cd": text("l_suppkey % 25 + 1"),
            "lbs_chm_used": "l_quantity",
        },
    ),
    "old_county": View(
        "nation",
        {"CountyCode": text("6000 + n_nationkey + 1"), "FIPS": text("6000 + n_nationkey * 2 + 1"), "Name": "n_name"},
    ),
    "orders_point": View(
        "orders",
        {
            "point": "o_orderkey",
            "x": "CAST((o_orderkey * 7919 % 100003) AS DOUBLE) / 10000.3e0",
            "y": "CAST((o_orderkey * 104729 % 99991) AS DOUBLE) / 9999.1e0",
        },
    ),
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Inputs:
    """Test tables and views of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._read:  # the schema is read from the file once
                path = f"{self.folder}/{name}.parquet"
                self._read[name] = self.spark.read.parquet(path)
            return self._read[name]
        view = VIEWS[name]
        df = spread(self(view.source))
        if view.where:
            df = df.where(view.where)
        if view.expand:
            df = df.selectExpr("*", f"{view.expand[0]} AS k")
        return df.selectExpr(
            *[f"{e if isinstance(e, str) else e[0]} AS `{n}`" for n, e in view.columns.items()]
        )


def _duck(view: View) -> str:
    columns = ", ".join(
        f'{e if isinstance(e, str) else e[1]} AS "{n}"' for n, e in view.columns.items()
    )
    source = view.source
    if view.expand:
        inner = f"SELECT *, {view.expand[1]} AS k FROM {source}"
        if view.where:
            inner += f" WHERE {view.where}"
        return f"SELECT {columns} FROM ({inner})"
    return f"SELECT {columns} FROM {source}" + (f" WHERE {view.where}" if view.where else "")


def compose(query: str, named: Mapping[str, str]) -> str:
    """Prefix ``query`` with the views and named subqueries it mentions."""
    bodies = {**{n: _duck(v) for n, v in VIEWS.items()}, **named}
    chosen: dict[str, str] = {}

    def visit(text_: str) -> None:
        for name, body in bodies.items():
            if name not in chosen and re.search(rf"(?<![\w'\"`.]){name}(?![\w'\"`])", text_):
                chosen[name] = ""  # guards against visiting twice
                visit(body)
                del chosen[name]
                chosen[name] = body

    visit(query)
    if not chosen:
        return query
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in chosen.items())
    return f"WITH {ctes}\n{query}"

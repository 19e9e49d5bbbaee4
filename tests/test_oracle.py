"""Every registered query with SQL, against DuckDB on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from arealytics.catalog.views import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES = contract.queries()
SQL = contract.oracle_sql()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "array<string>": "VARCHAR[]",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'"
        )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return tuple(value) if isinstance(value, list) else value


def _sorted(found):
    return sorted(found, key=lambda r: [(v is None, str(type(v)), 0 if v is None else v) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    assert {c: described[c] for c in columns} == {
        f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields
    }
    order = [list(described).index(c) for c in columns]
    theirs = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    ours = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    assert _sorted(ours) == _sorted(theirs)


def test_queries_without_sql_run(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "monthyear",
        "GEOID",
        "lbs_chm_used",
        "lbs_prd_used",
    ]

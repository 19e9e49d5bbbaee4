import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from arealytics.session import build_session, drop_pinned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_pinned(session)
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Make every size check fail, as beyond the threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def rows(df, *columns):
    """Sorted row tuples; None sorts last."""
    picked = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(picked, key=lambda r: [(v is None, str(type(v)), 0 if v is None else v) for v in r])

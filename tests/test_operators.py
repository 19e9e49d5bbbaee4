import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Observation, functions as F

from arealytics import session
from arealytics.operators import aggregates, crosswalk, filters, joins, keys
from arealytics.plans import units
from arealytics.specs import TRACT


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, a third without a key."""
    made = random.Random(3)
    data = [
        (["hot", None, f"k{made.randrange(40)}"][i % 3], i) for i in range(3000)
    ]
    return spark.createDataFrame(data, "k string, v long").repartition(5)


@pytest.fixture(scope="module")
def lookup(spark):
    data = [("hot", "a"), ("hot", "b"), (None, "never")]
    data += [(f"k{i}", f"x{i}") for i in range(30)]
    return spark.createDataFrame(data, "k string, w string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(skewed, lookup, how):
    plain = rows(skewed.join(lookup, "k", how), "k", "v", "w")
    assert rows(joins.lookup_join(skewed, lookup, ["k"], how, small=True), "k", "v", "w") == plain
    assert rows(joins.lookup_join(skewed, lookup, ["k"], how, small=False), "k", "v", "w") == plain


def test_hot_keys_are_few_and_proportional(skewed):
    found = {r["k"]: r["_spread"] for r in joins.hot_keys(skewed, ["k"], 10).collect()}
    assert found == {"hot": 4, None: 4}


def test_large_side_is_not_broadcast(spark, skewed, lookup, no_broadcast, capsys):
    assert not joins.fits_broadcast(lookup)
    joined = joins.lookup_join(skewed, lookup, ["k"])
    joined.explain()
    plan = capsys.readouterr().out
    assert "_salt" in plan and "SortMergeJoin" in plan
    assert joined.count() == skewed.join(lookup, "k", "left").count()


@pytest.mark.parametrize("small", [True, False])
def test_dense_index(spark, skewed, small, request):
    if not small:
        request.getfixturevalue("no_broadcast")
    df = skewed.withColumn("key", F.col("k"))
    out = keys.dense_index(df, ["k"])
    pairs = out.select("key", "use_index").distinct().collect()
    present = sorted(r["key"] for r in pairs if r["key"] is not None)
    expected = {k: i for i, k in enumerate(present)} | {None: len(present)}
    assert {r["key"]: r["use_index"] for r in pairs} == expected
    assert out.count() == 3000
    again = keys.dense_index(df.repartition(7, "v"), ["k"])
    assert rows(again, "v", "use_index") == rows(out, "v", "use_index")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("partitioning(")


def test_dense_index_moves_rows_once(spark, skewed):
    df = spark.createDataFrame(skewed.toPandas(), skewed.schema)
    assert shuffles(keys._counted(df, ["k"])) == 1
    # afterwards only the few rows of range offsets are sent around
    assert shuffles(keys.dense_index(df, ["k"])) == 0


def test_dense_index_with_borders_inside_keys(spark):
    # more ranges than keys: most borders fall inside a key, a range may be empty
    data = [(k, part, v) for k, part in ((None, "x"), ("a", None), ("b", "x"), ("b", "y"), ("c", "x")) for v in range(200)]
    df = spark.createDataFrame(data, "k string, part string, v int").withColumns({"_k": F.col("k"), "_p": F.col("part")})
    out = keys.dense_index(df.repartition(5, "v"), ["k", "part"]).select("_k", "_p", "use_index").distinct().collect()
    expected = {("b", "x"): 0, ("b", "y"): 1, ("c", "x"): 2, (None, "x"): 3, ("a", None): 3}
    assert {(r._k, r._p): r.use_index for r in out} == expected and len(out) == 5
    assert keys.dense_index(df.limit(0), ["k", "part"]).collect() == []
    nulls = keys.dense_index(df.where("k IS NULL"), ["k", "part"])
    assert {r.use_index for r in nulls.collect()} == {0}


def test_dense_index_stores_no_keys_but_those_at_range_ends(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    stored = []
    monkeypatch.setattr(keys, "pin", lambda part: stored.append(session.pin(part)) or stored[-1])
    out = keys.dense_index(df, ["k"])
    order = sorted(map(str, range(400)))
    assert [order[r.use_index] for r in out.orderBy("v").collect()] == [str(i) for i in range(400)]
    assert "k" not in stored[0].columns
    assert stored[0].where("_end IS NOT NULL").count() <= 2 * 2 * 4  # of two ranges to a task


def test_pin_gives_back_the_shuffle_files_of_its_way(spark):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return set(re.findall(r"shuffle_(\d+)_", blocks.mkString(" ")))

    before = shuffled()
    kept = session.pin(spark.range(1000).repartition(3, "id"))
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before and kept.count() == 1000
    assert spark.conf.get(session.CLEAN_UP, "false") == "false"


def test_levels_that_come_one_by_one_are_given_back(spark):
    rows_ = [(1, "AG", 2.0, 3.0), (1, "AG", 4.0, 3.0), (2, None, 1.0, 5.0)]
    fact = spark.createDataFrame(rows_, "use_id int, usetype string, lbs_chm_used double, lbs_prd_used double")
    there, held = [], []

    def levels():
        for name in ("county", "section"):
            held.append(sum(Path(f.removeprefix("file:")).exists() for files in there for f in files))
            level = keys.dense_index(fact, ["use_id"])
            there.append(level.inputFiles())
            yield name, level

    out = units.reconcile(fact, levels())
    assert {r["diff"] for r in out.collect()} == {0.0} and out.count() == 8
    assert held == [0, 0] and all(there)
    kept = keys.dense_index(fact, ["use_id"])
    units.reconcile(fact, {"county": kept})
    assert kept.count() == 3


def python_nodes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Arrow")


def test_dense_index_numbers_rows_without_python(spark, skewed):
    df = spark.createDataFrame(skewed.toPandas(), skewed.schema)
    assert python_nodes(keys._counted(df, ["k"])) == python_nodes(df)


def test_dense_index_deals_hot_keys_to_several_ranges(spark):
    data = [(1, 2020.5, v) for v in range(900)] + [(None, 1.0, v) for v in range(900)] + [(k, 1.0, k) for k in range(2, 50)]
    df = spark.createDataFrame(data, "k int, x double, v int").withColumns({"_k": F.col("k"), "_x": F.col("x")})
    counted = keys._counted(df, ["k", "x"])
    spread = {r.k: r.n for r in counted.groupBy("k").agg(F.countDistinct("_part").alias("n")).collect()}
    assert spread[1] > 1 and spread[None] > 1
    out = keys.dense_index(df, ["k", "x"])
    found = {(r._k, r._x, r.use_index) for r in out.collect()}
    expected = {(1, 2020.5, 0), (None, 1.0, 49)} | {(k, 1.0, k - 1) for k in range(2, 50)}
    assert found == expected and out.count() == len(data)


def test_plain_pounds_read_as_the_long_form(spark):
    values = [1.0, 12.25, 0.1 + 0.2, 0.5, 9999999.99, 9999999.999999998, 1e7, 123456.7890123, 1.1 + 2.2, 100.0, -3.5, 0.0]
    values += [1.23456789012345, 1.234567890123456, 1048576.0, 4.35, 2.675]
    df = spark.createDataFrame([("m", "n", v, "s") for v in values], "monthyear string, use_number string, lbs_prd_used double, comtrs string")
    expected = []
    for v in values:
        text = f"{v:.14e}"
        left = v - float(text)
        expected.append(f"mn{text}{f'{left:+.14e}' if left else ''}s")
    assert [r[0] for r in df.select(keys.use_id()).collect()] == expected


def test_keys_tell_all_doubles_apart(spark):
    values = [0.1 + 0.2, 0.3, 1e300, np.nextafter(1e300, 2e300), 5e-324, 0.0, -7.25, 123456789.123456789]
    values += [np.nextafter(123456789.123456789, 0), 1.0, np.nextafter(1.0, 2)]
    df = spark.createDataFrame([("2020-01", "n", float(v), "s") for v in values], "monthyear string, use_number string, lbs_prd_used double, comtrs string")
    found = [r[0] for r in df.select(keys.use_id()).collect()]
    assert len(set(found)) == len(values) and found[-2] == "2020-01n1.00000000000000e+00s"


def test_ranges_are_in_order(spark):
    df = spark.createDataFrame([(i * 37 % 100,) for i in range(100)], "v int")
    ranged = keys.with_offset(keys.in_ranges(df, ["v"]), F.count(F.lit(1)))
    out = ranged.select("v", F.col("_offset") + F.col("_place")).collect()
    assert sorted(map(tuple, out)) == [(i, i) for i in range(100)]


def test_quantiles_with_one_frequent_value(spark):
    values = [float(v) for v in [3] * 400 + list(range(600))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = aggregates.exact_quantiles(df, "v", [0.1, 0.35, 0.5, 0.999])
    assert np.allclose(found, np.quantile(values, [0.1, 0.35, 0.5, 0.999]))


def test_exact_quantiles(spark):
    values = [random.Random(5).gauss(0, 10) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    found = aggregates.exact_quantiles(df, "v", [0.2, 0.4, 0.6, 0.8])
    assert np.allclose(found, np.quantile(values, [0.2, 0.4, 0.6, 0.8]))
    assert aggregates.exact_quantiles(df.where("v IS NULL"), "v", [0.5]) == []


def test_quantile_bins_isolate_zero_and_null(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    out = {r["v"]: r["bin"] for r in aggregates.quantile_bins(df, "v").collect()}
    assert out[0.0] is None and out[None] is None
    assert [out[float(v)] for v in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_use_stats(spark):
    fact = spark.createDataFrame(
        [
            ("a", "2020-01", 10.0),
            ("a", "2020-01", 5.0),
            ("a", "2021-02", 1.0),
            ("a", None, 100.0),
            ("b", "2020-03", None),
            ("c", None, 4.0),
            (None, "2020-01", 7.0),
        ],
        "chem_code string, monthyear string, lbs_chm_used double",
    )
    found = {r["chem_code"]: tuple(r)[1:] for r in aggregates.use_stats(fact, "chem_code").collect()}
    assert found == {
        "a": (116.0, 8.0, 15.0, 8.0, ["2020", "2021"], ["2020-01", "2021-02"]),
        "b": (0.0, 0.0, 0.0, 0.0, ["2020"], ["2020-03"]),
    }


def test_file_year(spark):
    df = spark.createDataFrame(
        [("f", 2020), ("f", 2021), ("f", None), ("g", 2019), ("g", 2019), ("g", 2020)],
        "file string, YEAR int",
    )
    assert rows(aggregates.file_year(df, "file")) == [("f", 2020), ("g", 2019)]
    assert aggregates.assign_file_year(df, "file").where("YEAR = 2020").count() == 3
    lost = df.union(spark.createDataFrame([("h", None)], df.schema))
    with pytest.raises(Exception, match="no year in file h"):
        aggregates.assign_file_year(lost, "file").collect()


def test_first_rows(spark):
    df = spark.createDataFrame(
        [("a", 3, None), ("a", 1, "x"), (None, 2, "y"), (None, 5, "z")],
        "k string, ordinal int, v string",
    )
    assert rows(keys.first_row_id(df, "k", "ordinal")) == [("a", 1), (None, 2)]
    assert rows(keys.first_per_key(df, ["k"], "ordinal")) == [("a", 1, "x"), (None, 2, "y")]


def test_use_id(spark):
    df = spark.createDataFrame(
        [
            ("2020-01", "7", 1e7, None), (None, "7", 1.0, "s"), ("2020-01", "7", 0.5, "s"),
            ("2020-01", None, 0.5, "s"), ("2020-01", "7", 1e-5, "s"), ("2020-01", "7", 4e-5, "s"),
        ],
        "monthyear string, use_number string, lbs_prd_used double, comtrs string",
    )
    assert [r[0] for r in df.select(keys.use_id()).collect()] == [
        "2020-0171.00000000000000e+07nan",
        None,
        "2020-0175.00000000000000e-01s",
        "2020-01nan5.00000000000000e-01s",
        "2020-0171.00000000000000e-05s",
        "2020-0174.00000000000000e-05s",
    ]


def test_normalize_keeps_dominant_only(spark):
    df = spark.createDataFrame(
        [
            ("a", "t1", 0.96), ("a", "t2", 0.04),
            ("b", "t1", 0.95), ("b", "t2", 0.03),
            ("c", "t1", 0.0),
        ],
        "s string, t string, AREA_RATIO double",
    )
    found = {(r["s"], r["t"]): r["AREA_RATIO"] for r in crosswalk.normalize_ratios(df, "s").collect()}
    assert found == {
        ("a", "t1"): pytest.approx(1.0),
        ("b", "t1"): pytest.approx(0.95 / 0.98),
        ("b", "t2"): pytest.approx(0.03 / 0.98),
        ("c", "t1"): None,
    }


def test_apportion_keeps_covered_pounds(spark, no_broadcast):
    fact = spark.createDataFrame(
        [("2020-01", "1", "s1", "AG", 10.0, 4.0, 1.0, "m", "u1"),
         ("2020-01", "2", "s2", "AG", 6.0, 2.0, 1.0, "m", "u2"),
         ("2020-01", "3", "s9", "AG", 5.0, 1.0, 1.0, "m", "u3"),
         ("2020-01", "4", "s1", "NONAG", 9.0, 1.0, 1.0, "m", "u4")],
        "monthyear string, use_number string, comtrs string, usetype string, lbs_chm_used double,"
        " lbs_prd_used double, prodchem_pct double, MeridianTownshipRange string, use_id string",
    )
    xwalk = spark.createDataFrame(
        [("s1", "a", 1.0), ("s2", "a", 0.25), ("s2", "b", 0.75)],
        "CO_MTRS string, GEOID string, AREA_RATIO double",
    )
    out = crosswalk.apportion(fact, xwalk, TRACT)
    assert set(out.columns) == {
        "monthyear", "use_number", "usetype", "lbs_chm_used", "lbs_prd_used", "GEOID", "use_index",
    }
    assert rows(out, "GEOID", "lbs_chm_used", "use_index") == [
        ("a", 1.5, 1), ("a", 10.0, 0), ("b", 4.5, 2), (None, None, 3),
    ]
    checked = units.reconcile(fact, {"tract": out}, frozenset({"tract"}))
    assert rows(checked, "measure", "base", "derived", "diff") == [
        ("chm_ag", 21.0, 16.0, 5.0), ("prd_ag", 7.0, 6.0, 1.0),
    ]


def test_filters(spark):
    df = spark.createDataFrame(
        [("2020-01", "AG", "1"), ("2020-02", "NONAG", "2"), ("2020-03", None, "3")],
        "monthyear string, usetype string, site_code string",
    )
    kept = lambda p: [r["site_code"] for r in filters.usage_filter(df, p).collect()]
    assert kept({"start": "2020-02", "end": "2020-03"}) == ["2", "3"]
    assert kept({"usetype": "*", "site": []}) == ["1", "2", "3"]
    assert kept({"site": ["1", "3"], "usetype": "AG"}) == ["1"]
    with pytest.raises(ValueError, match="unknown filter"):
        kept({"nope": 1})
    passed = df.where(filters.not_equal_or_null(F.col("usetype"), "AG"))
    assert passed.count() == 2


def test_dropped_rows_are_counted(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "DATE string")
    seen = Observation("dates")
    assert filters.drop_null(df, "DATE", seen).count() == 1
    assert seen.get["dropped"] == 2


def test_filters_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "fact")
    spark.createDataFrame(
        [("2020-01", "AG", "1", 2.0)],
        "monthyear string, usetype string, site_code string, lbs_chm_used double",
    ).write.parquet(path)
    out = filters.use_over_time(
        spark.read.parquet(path), "usetype", params={"start": "2020-01", "site": ["1", "2"]}
    )
    out.explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(monthyear,2020-01)" in plan and "In(site_code, [1,2])" in plan

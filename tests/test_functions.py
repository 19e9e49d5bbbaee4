import pytest
from pyspark.sql import functions as F

from arealytics.functions import dates, numbers, projection, text
from arealytics.specs import CLASSES, HEALTH, Label


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def listed(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_clean_numeric_blanks_and_junk(spark):
    df = column(spark, ["12.5", None, "nan", "MARCH", "", "7"])
    out = numbers.clean_numeric(df, ["x"], ["nan", "MARCH"])
    assert listed(out, "x") == [12.5, 0.0, 0.0, 0.0, 0.0, 7.0]
    junk = column(spark, ["12.5", "acres"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        numbers.clean_numeric(junk, ["x"], []).collect()
    assert listed(numbers.clean_numeric(junk, ["x"], [], "permissive"), "x") == [12.5, 0.0]


def test_clean_code_truncates(spark):
    df = column(spark, ["12.7", "GA", "-3.9", None, "253", "x1", "nan"])
    out = numbers.clean_code(df, ["x"], ["GA"])
    assert listed(out, "x") == ["12", "0", "-3", "0", "253", "0", "0"]


def test_numeric_if_all(spark):
    df = spark.createDataFrame(
        [("1", "1", "a"), (None, "2.5", "b")], "a string, b string, FIPS string"
    )
    mixed = spark.createDataFrame([("1", "x")], "a string, b string")
    assert [t for _, t in numbers.numeric_if_all(df, ["FIPS"]).dtypes] == [
        "double",
        "double",
        "string",
    ]
    assert [t for _, t in numbers.numeric_if_all(mixed, []).dtypes] == ["double", "string"]


def test_shares_round_half_to_even(spark):
    df = spark.createDataFrame(
        [(1, 16), (0, 0), (3, 0), (1, 3)], "a long, b long"
    ).select(
        numbers.share(F.col("a"), F.col("b"), 1).alias("s"),
        numbers.guarded_share(F.col("a"), F.col("b")).alias("g"),
    )
    assert [tuple(r) for r in df.collect()] == [(6.2, 6), (None, 0), (None, 0), (33.3, 33)]


def test_month_year_is_strict(spark):
    df = column(spark, ["05-MAR-21", "05-Mar-21", "31-FEB-20", None])
    assert listed(df, dates.month_year(F.col("x"))) == ["2021-03", None, "2020-02", None]
    assert listed(df, dates.parsed_month(F.col("x"))) == ["2021-03", "2021-03", None, None]


def test_slash_date(spark):
    df = column(spark, ["03/05/2019", "nan", "x", None])
    out = [str(d) if d else None for d in listed(df, dates.slash_date(F.col("x")))]
    assert out == ["2019-03-05", None, None, None]


def test_township_range(spark):
    df = column(spark, ["10M10N02E12", "10M10N02E", "10M10N02", None])
    assert listed(df, text.township_range(F.col("x"))) == [
        "T10N R02E",
        "T10N R02E",
        None,
        None,
    ]


def test_labels(spark):
    labels = [Label("A", "a", ("p", "q")), Label("B", "b", ("r",))]
    df = spark.createDataFrame(
        [("Y", None, "Y"), (None, "Y", "N"), (None, "y", None)],
        "p string, q string, r string",
    ).withColumn("x", text.label_string(labels))
    assert listed(df, "x") == ["A|B", "A", ""]
    assert listed(df, text.label_count(F.col("x"))) == [2, 1, 1]
    assert listed(column(spark, [None]), text.label_count(F.col("x"))) == [0]
    assert (len(HEALTH), len(CLASSES)) == (6, 26)


def test_title_case(spark):
    df = column(spark, ["REG/HERB", "plant growth", "o2x", None])
    assert listed(df, text.title_case(F.col("x"))) == [
        "Reg/Herb",
        "Plant Growth",
        "O2X",
        None,
    ]


def test_padding_words_and_districts(spark):
    df = column(spark, ["7", "1234", None])
    assert listed(df, text.zero_pad(F.col("x"), 3)) == ["007", "1234", None]
    words = column(spark, ["ZCTA5 93210", "one"])
    assert listed(words, text.nth_word(F.col("x"), 2)) == ["93210", None]
    pair = spark.createDataFrame(
        [("0612345", "0699998"), (None, "0699998"), (None, None)], "a string, b string"
    )
    assert listed(pair, text.district_id(F.col("a"), F.col("b"))) == [
        "12345",
        "99998",
        None,
    ]


def test_projection_keeps_area_and_meridian(spark):
    df = spark.range(1).select(
        *[
            projection.project_albers(F.lit(lon), F.lit(lat)).alias(name)
            for name, lon, lat in [("m", -120.0, 37.0), ("w", -121.0, 37.0), ("e", -119.0, 37.0)]
        ]
    )
    m, w, e = df.first()
    assert abs(m["x"]) < 1e-6 and abs(w["x"] + e["x"]) < 1e-6 and w["y"] == e["y"]
    # the false northing puts latitude 38 near the origin of the grid
    assert -1.3e5 < m["y"] < -1.0e5

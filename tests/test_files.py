import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from arealytics import sinks
from arealytics.operators import geometry
from arealytics.plans import clean, demography, dimensions, older, units
from arealytics.sources import reports, tables
from arealytics.specs import CHEMICALS, COUNTY, RESTRICTED, SECTION, TOWNSHIP
from arealytics.operators.aggregates import assign_file_year
from arealytics.streaming.ingest import ingest_new

COLUMNS = reports.RAW_COLUMNS
DEFAULT = {
    "YEAR": "2021", "ADJUVANT": "N", "DATE": "05-MAR-21", "COMTRS": "10M10N02E12",
    "POUNDS_CHEMICAL_APPLIED": "12.5", "AERIAL_GROUND_INDICATOR": "G", "AG_NONAG": "AG",
    "AMOUNT_PLANTED": "3", "CHEMICAL_CODE": "253.0", "COUNTY_CODE": "10",
    "POUNDS_PRODUCT_APPLIED": "20", "PRODUCT_CHEMICAL_PERCENT": "50",
    "PRODUCT_NUMBER": "7", "SITE_CODE": "GA", "USE_NUMBER": "1001",
}


def report(*changes):
    lines = ["\t".join(COLUMNS)]
    lines += ["\t".join((DEFAULT | c)[k] or "" for k in COLUMNS) for c in changes]
    return "\n".join(lines) + "\n"


def test_plain_reports(spark, tmp_path):
    (tmp_path / "a.txt").write_text(report({}, {"DATE": None}))
    for columns in (COLUMNS, None):
        df = reports.read_use_reports(spark, str(tmp_path / "a.txt"), columns)
        assert rows(df, "DATE", "CHEMICAL_CODE") == [("05-MAR-21", "253.0"), (None, "253.0")]
        assert all(r["_file"].endswith("/a.txt") for r in df.collect())


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    for year in ("2001", "2002"):
        (tmp_path / f"pur{year}").mkdir()
        (tmp_path / f"pur{year}" / "udc01.txt").write_text(report({"YEAR": year}, {"YEAR": year}))
    df = reports.read_use_reports(spark, str(tmp_path) + "/pur*/udc01.txt", COLUMNS)
    assigned = assign_file_year(df, "_file")
    assert rows(assigned.groupBy("YEAR").count()) == [(2001, 2), (2002, 2)]


def test_both_readers_know_the_same_nulls(spark, tmp_path):
    body = report({"SITE_CODE": "NA"}, {"SITE_CODE": "null"}, {"SITE_CODE": "12"})
    (tmp_path / "y.txt").write_text(body)
    with zipfile.ZipFile(tmp_path / "y.zip", "w") as archive:
        archive.writestr("y.txt", body)
    plain = reports.read_use_reports(spark, str(tmp_path / "y.txt"), COLUMNS)
    zipped, _ = reports.read_zipped_reports(spark, str(tmp_path), COLUMNS)
    assert rows(plain, "SITE_CODE") == rows(zipped, "SITE_CODE") == [("12",), (None,), (None,)]


def test_zipped_reports_quarantine(spark, tmp_path):
    for name, body in {"y1": report({}, {}), "y2": report({"YEAR": "2020"})}.items():
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr(f"{name}.txt", body)
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    with zipfile.ZipFile(tmp_path / "late.zip", "w") as archive:
        archive.writestr("late.txt", report({}, {}) + "x" + "\ty" * 40 + "\n")
    found, failures = reports.read_zipped_reports(spark, str(tmp_path))
    counts = rows(found.groupBy("_file").count())
    assert [(f.rpartition("/")[2], n) for f, n in counts] == [("y1.zip", 2), ("y2.zip", 1)]
    failed = [r["_file"].rpartition("/")[2] for r in failures.orderBy("_file").collect()]
    assert failed == ["broken.zip", "late.zip"]


def test_yearly_tables(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    for year in ("2020", "2021"):
        row = tuple((DEFAULT | {"YEAR": year})[c] for c in COLUMNS)
        df = spark.createDataFrame([row], schema).withColumn("extra", F.lit(1))
        df.select(*reversed(df.columns)).write.parquet(str(tmp_path / f"use_{year}.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "use_full.parquet"))
    out = reports.read_yearly(spark, str(tmp_path), "use", COLUMNS)
    assert out.columns == COLUMNS and rows(out, "YEAR") == [("2020",), ("2021",)]
    with pytest.raises(FileNotFoundError):
        reports.read_yearly(spark, str(tmp_path), "none", COLUMNS)


def test_ragged_years_skip_missing(spark, tmp_path):
    for year, body in {2001: "a,b\n1,2\n", 2003: "a,c\n3,4\n"}.items():
        (tmp_path / f"pur{year}").mkdir()
        (tmp_path / f"pur{year}" / "udc1.txt").write_text(body)
    out = reports.read_ragged_years(spark, str(tmp_path) + "/pur{year}/udc*.txt", range(2001, 2005))
    assert rows(out, "a", "b", "c", "_year") == [("1", "2", None, 2001), ("3", None, "4", 2003)]


def test_ragged_years_scan_each_header_once(spark, tmp_path):
    for year in range(2001, 2007):
        folder = tmp_path / f"pur{year}" / (f"pur{year}" if year == 2004 else "")
        folder.mkdir(parents=True)
        for part in (1, 2):
            head, row = ("a,b", "1,2") if year % 2 else ("b,c", "3,\"x, y\"")
            (folder / f"udc {part}.txt").write_text(f"{head}\n{row}\n")
    # the folder of a year repeated inside it is taken instead
    (tmp_path / "pur2004" / "udc 9.txt").write_text("z\n1\n")
    out = reports.read_ragged_years(spark, str(tmp_path) + "/pur{year}/udc*.txt", range(2000, 2008))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    expected = [("1", "2", None, y) for y in (2001, 2003, 2005)] + [(None, "3", "x, y", y) for y in (2002, 2004, 2006)]
    assert sorted(rows(out, "a", "b", "c", "_year"), key=str) == sorted(expected * 2, key=str)
    with pytest.raises(FileNotFoundError):
        reports.read_ragged_years(spark, str(tmp_path) + "/none{year}/udc*.txt", range(2000, 2008))


def test_archives_are_read_in_chunks(spark, tmp_path):
    for name, count in {"big": 950, "small": 3}.items():
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{name}.txt", report(*[{"USE_NUMBER": f"{name}{i}"} for i in range(count)]))
    (tmp_path / "torn.zip").write_bytes((tmp_path / "big.zip").read_bytes()[:-300])
    read, failures = reports.read_zipped_reports(spark, str(tmp_path), COLUMNS, chunk_rows=10)
    assert read.count() == 953 and read.select("USE_NUMBER").distinct().count() == 953
    assert [r["_file"].rsplit("/", 1)[1] for r in failures.collect()] == ["torn.zip"]
    none, failed = reports.read_zipped_reports(spark, str(tmp_path / "none"), COLUMNS)
    assert none.count() == failed.count() == 0 and none.columns == [*COLUMNS, "_file"]


def test_versions_leave_no_gap(spark, tmp_path):
    root = str(tmp_path / "table")
    for number in range(1, 5):
        sinks.publish_version(spark.range(number), root)
        reader = sinks.published(spark, root)
        assert reader.count() == number
        if number > 1:
            # a reader of the version before, and one that comes while a new
            # version is half written
            assert before.count() == number - 1
        (tmp_path / "table" / f"v{number + 1:010d}").mkdir()
        assert sinks.published(spark, root).count() == number
        (tmp_path / "table" / f"v{number + 1:010d}").rmdir()
        before = reader
    assert sorted(sinks.versions(spark, root)) == [3, 4]


def test_section_keys_of_the_older_layout(spark):
    use = spark.createDataFrame(
        [("03/05/2018", "S1", "1"), ("03/05/2018", None, "2"), ("03/05/2018", "S9", "2"), ("01/01/2001", "S1", "1")],
        "applic_dt string, comtrs string, county_cd string",
    )
    keys = spark.createDataFrame([("S1", "T1", "Z1"), ("S1", "T1", "Z1"), (None, "T2", "Z2")], "CO_MTRS string, GEOID string, ZIP string")
    counties = spark.createDataFrame([("6001", "6001", "A"), ("6002", "6003", "B")], "CountyCode string, FIPS string, Name string")
    out = older.older_use(use, counties, keys=keys)
    assert rows(out, "comtrs", "GEOID", "ZIP", "Name") == [
        ("S1", "T1", "Z1", "A"), ("S9", None, None, "B"), (None, None, None, "B"),
    ]


def test_code_tables(spark, tmp_path):
    path = tmp_path / "chemical.txt"
    path.write_bytes('chem_code,chemname\n"253","CHLORPYRIFOS \xe9"\n'.encode("latin-1"))
    out = tables.read_dimension(spark, str(path), CHEMICALS)
    assert rows(out) == [("253", "CHLORPYRIFOS é")]
    fips = tmp_path / "fips.csv"
    fips.write_text("DPR_ID,FIPS\n1,06001\n")
    assert rows(tables.read_text_csv(spark, str(fips))) == [("1", "06001")]


def test_restricted_list(spark, tmp_path):
    path = tmp_path / "restricted.csv"
    path.write_text("t1,t2,t3,t4\nName,DPR chem code,Restricted,_\nA,253,x,\nB,various,x,\nC,253.0,x,\n")
    read = tables.read_restricted(spark, str(path))
    assert rows(dimensions.restricted_codes(read)) == [("253", "Y"), ("253", "Y")]


def test_records(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text(json.dumps([{"FIPS": "6001", "Name": "n"}, {"FIPS": "6003", "Name": None}]))
    out = tables.read_records(spark, str(path), "FIPS string, Name string")
    assert rows(out) == [("6001", "n"), ("6003", None)]


def test_links(spark):
    html = "<A class=x HREF='/files/County_A.zip'>a</a><a href=\"/other.zip\">o</a><a name=q>County_</a>"
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows(tables.harvest_links(df, "County_")) == [(1, 0, "/files/County_A.zip", "County_A.zip")]


def test_write_year_replaces_only_its_years(spark, tmp_path):
    path = str(tmp_path / "years")
    schema = "YEAR int, v string"
    sinks.write_year(spark.createDataFrame([(2020, "a"), (2021, "b")], schema), path)
    sinks.write_year(spark.createDataFrame([(2021, "c"), (2021, "d")], schema), path)
    assert rows(spark.read.parquet(path), "YEAR", "v") == [(2020, "a"), (2021, "c"), (2021, "d")]


def test_ledger_and_pending(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert sinks.read_ledger(spark, ledger).count() == 0
    for name in ("a", "b", "a"):
        sinks.append_ledger(spark.createDataFrame([(name,)], "name string"), ledger)
    listing = spark.createDataFrame([("a",), ("c",), ("full",)], "name string")
    present = sinks.read_ledger(spark, ledger).union(spark.createDataFrame([("full",)], "name string"))
    assert rows(sinks.pending_files(listing, present, "full")) == [("c",), ("full",)]


def test_publish_keeps_backup(spark, tmp_path):
    path, backup = str(tmp_path / "out" / "t"), str(tmp_path / "backup" / "t")
    for n in (1, 2, 3):
        sinks.publish(spark.range(n), path, backup)
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(backup).count() == 2


def test_plain_sinks(spark, tmp_path):
    df = spark.createDataFrame([("06001", None), ("06003", "B")], "FIPS string, name string")
    sinks.write_json(sinks.label_values(df, "FIPS", "name"), str(tmp_path / "j"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert {"value": "06001", "label": None} in lines and len(lines) == 2
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    sinks.write_plain(df, str(tmp_path / "p"))
    sinks.write_fact(df, str(tmp_path / "f"), ["FIPS"])
    assert [spark.read.parquet(str(tmp_path / x)).count() for x in "pf"] == [2, 2]
    assert any("gz" in f.name for f in (tmp_path / "f").iterdir())


def test_incremental_ingest(spark, tmp_path):
    inbox, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    (inbox / "a.txt").write_text(report({}, {"DATE": None}, {"YEAR": "2019"}, {}))
    ingest_new(spark, str(inbox), target, state).awaitTermination()
    (inbox / "b.txt").write_text(report({"YEAR": "2020"}))
    ingest_new(spark, str(inbox), target, state).awaitTermination()
    assert rows(spark.read.parquet(target).groupBy("YEAR").count()) == [(2020, 1), (2021, 3)]
    # another file of a year that is there already
    (inbox / "c.txt").write_text(report({}, {}))
    ingest_new(spark, str(inbox), target, state).awaitTermination()
    assert rows(spark.read.parquet(target).groupBy("YEAR").count()) == [(2020, 1), (2021, 5)]


@pytest.fixture(scope="module")
def fact(spark):
    made = [
        {},
        {"CHEMICAL_CODE": "12.7", "DATE": "05-Mar-21", "POUNDS_CHEMICAL_APPLIED": "MARCH"},
        {"COMTRS": None, "AG_NONAG": "NONAG", "USE_NUMBER": "1002"},
        {"COMTRS": "10S01", "CHEMICAL_CODE": "999"},
    ]
    raw = spark.createDataFrame(
        [tuple((DEFAULT | m)[c] for c in COLUMNS) for m in made],
        ", ".join(f"{c} string" for c in COLUMNS),
    )
    meridians = spark.createDataFrame([("10M10N02E12", "MDM")], "CO_MTRS string, Meridian string")
    return clean.clean_use(raw, meridians)


def test_clean_use(fact):
    found = rows(fact, "chem_code", "lbs_chm_used", "site_code", "monthyear", "MeridianTownshipRange")
    assert found == [
        ("12", 0.0, "0", None, "MDM T10N R02E"),
        ("253", 12.5, "0", "2021-03", "MDM T10N R02E"),
        ("253", 12.5, "0", "2021-03", None),
        ("999", 12.5, "0", "2021-03", None),
    ]


def test_unit_tables(spark, fact):
    categories = spark.createDataFrame([("253", "OP", "4", "")] * 2, "chem_code string, major_category string, ai_type string, health string")
    base = units.enrich(fact, categories)
    assert base.count() == 4
    section = units.unit_fact(base, SECTION)
    township = units.unit_fact(base, TOWNSHIP)
    assert township.where("MeridianTownshipRange = ''").count() == 2
    assert "comtrs" not in township.columns and "use_id" not in section.columns
    assert units.unit_fact(base, TOWNSHIP, apply_usetype=True).count() == 4  # the spec has none
    fips = spark.createDataFrame([(10, "06019")], "DPR_ID int, FIPS string")
    county = units.county_fact(base, fips, COUNTY)
    assert {r["FIPS"] for r in county.collect()} == {"06019"}
    # three keyed applications, then the row without a month
    assert rows(county.select("use_index").distinct()) == [(0,), (1,), (2,), (3,)]
    checked = units.reconcile(base, {"county": county, "section": section})
    assert {r["diff"] for r in checked.collect()} == {0.0}


def test_all_unit_tables_reconcile(spark, fact):
    categories = spark.createDataFrame([("253", "OP", "4", "")], "chem_code string, major_category string, ai_type string, health string")
    fips = spark.createDataFrame([("10", "06019")], "DPR_ID string, FIPS string")
    halves = [("10M10N02E12", "a", 0.5), ("10M10N02E12", "b", 0.5), ("10S01", "a", 1.0)]
    walks = {
        name: spark.createDataFrame(halves, f"CO_MTRS string, {area} string, AREA_RATIO double")
        for name, area in [("tract", "GEOID"), ("school", "FIPS"), ("zip", "ZCTA5CE20")]
    }
    base, tables = units.unit_tables(fact, categories, walks, fips)
    assert list(tables) == ["tract", "school", "zip", "county", "township", "section"]
    checked = units.reconcile(base, tables, units.AG_ONLY).collect()
    assert len(checked) == 4 * 2 + 2 * 4
    assert {r["diff"] for r in checked if r["measure"].startswith("chm")} == {0.0}


def test_categories(spark):
    flags = spark.createDataFrame(
        [(0, "1", None, "Y"), (1, "2", "ADJUVANT", "Y"), (2, "3", "REG", None), (3, "4", None, None)],
        "ordinal long, CHEM_CODE string, AI_TYPE string, OP string",
    )
    from arealytics.specs import FLAGS

    for flag in FLAGS:
        if flag != "OP":
            flags = flags.withColumn(flag, F.lit(None).cast("string"))
    listed = spark.createDataFrame([("3.0",), ("3",), ("x",)], "chem_code string")
    flagged = dimensions.flag_restricted(flags, listed)
    assert flagged.count() == 5 and flagged.where(f"`{RESTRICTED}` = 'Y'").count() == 2
    assert rows(dimensions.categories(flagged)) == [
        ("1", "OP", "0", "CHI"), ("3", "", "2", "RM"), ("4", "", "0", ""),
    ]
    assert rows(dimensions.use_type_codes(flagged)) == [("Reg", 2), (None, 0)]


def test_missing_income_option(spark):
    from arealytics.specs import COUNTS, INCOME

    tracts = spark.createDataFrame([("t1", 50000.0), ("t2", None)], "FIPS string, income double")
    tracts = tracts.withColumnRenamed("income", INCOME)
    for c in COUNTS:
        tracts = tracts.withColumn(c, F.lit(100))
    areas = spark.createDataFrame([("s", 9.0)], "comtrs string, ALAND double")
    xwalk = spark.createDataFrame([("s", "t1", 0.5), ("s", "t2", 0.5)], "comtrs string, GEOID string, AREA_RATIO double")
    income = lambda **k: demography.area_demography(areas, xwalk, tracts, "comtrs", **k).first()["Median HH Income"]
    assert income() == 25000.0
    assert income(ignore_missing_income=True) == 50000.0


def test_section_meridians(spark):
    square = lambda x, y, n: geometry.rings_from_points(
        F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in [(x, y), (x + n, y), (x + n, y + n), (x, y + n)]])
    )
    parts = [("t1", "MDM", 0, 0), ("t2", "MDM", 2, 0), ("t3", None, 4, 0)]
    frames = [spark.range(1).select(F.lit(i).alias("id"), F.lit(m).cast("string").alias("Meridian"), square(x, y, 2).alias("rings")) for i, m, x, y in parts]
    towns = frames[0].union(frames[1]).union(frames[2])
    centres = spark.createDataFrame([("a", 2.0, 1.0), ("b", 5.0, 1.0), ("c", 0.5, 0.5)], "point string, x double, y double")
    out = clean.section_meridians(centres, geometry.to_edges(towns, "id"), towns.select("id", "Meridian"))
    assert rows(out) == [("a", "MDM"), ("c", "MDM")]


def test_older_layout(spark):
    use = spark.createDataFrame(
        [("1", "03/05/2016", "s", "7"), ("2", "03/05/2019", None, "7"), ("3", "nan", "s", "7")],
        "use_no string, applic_dt string, comtrs string, county_cd string",
    )
    names = spark.createDataFrame([("6007", "6013", "x")], "CountyCode string, FIPS string, Name string")
    out = older.older_use(use, names)
    assert rows(out, "use_no", "usetype", "county_cd", "FIPS") == [("2", "nonag", "06007", "06013")]

"""From archives to published tables, over two runs."""

import shutil
import zipfile

import pytest
from conftest import rows
from test_files import COLUMNS, report

from arealytics import sinks
from arealytics.plans import clean, dimensions, jobs
from arealytics.sources import reports
from arealytics.specs import FLAGS

MERIDIANS = [("10M10N02E12", "MDM")]


def archive(folder, name, *changes):
    with zipfile.ZipFile(folder / f"{name}.zip", "w") as packed:
        packed.writestr(f"{name}.txt", report(*changes))


@pytest.fixture
def inputs(spark):
    text = lambda data, *names: spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    return {
        "meridians": text(MERIDIANS, "CO_MTRS", "Meridian"),
        "codes": {
            "chemicals": text([("253", "C"), ("12", "A"), ("5", "unused")], "chem_code", "chemname"),
            "sites": text([("0", "none"), ("8", "S")], "site_code", "site_name"),
            "products": text([("7", "P")], "prodno", "product_name"),
        },
        "flags": spark.createDataFrame(
            [(0, "253", "REG", "Y"), (1, "12", "ADJUVANT", None), (2, "5", "REG", "Y")],
            "ordinal long, CHEM_CODE string, AI_TYPE string, OP string",
        ),
        "restricted": text([("253", "x")], "chem_code", "name"),
        "fips": text([("10", "06019")], "DPR_ID", "FIPS"),
        "walks": {
            name: spark.createDataFrame([("10M10N02E12", "a", 1.0)], f"CO_MTRS string, {area} string, AREA_RATIO double")
            for name, area in (("tract", "GEOID"), ("school", "FIPS"), ("zip", "ZCTA5CE20"))
        },
    }


def whole(spark, inbox, inputs):
    """Code tables made at once from all readable archives."""
    raw, _ = reports.read_zipped_reports(spark, str(inbox))
    fact = clean.clean_use(raw.where("DATE IS NOT NULL"), inputs["meridians"])
    return dimensions.dimensions(fact, inputs["codes"], jobs.SPECS)


def test_two_runs_give_what_one_gives(spark, tmp_path, inputs):
    flags = inputs["flags"].selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`" for c in FLAGS if c != "OP"])
    inbox, home = tmp_path / "in", str(tmp_path / "home")
    inbox.mkdir()
    archive(inbox, "a", {}, {"DATE": "07-APR-21", "CHEMICAL_CODE": "12"}, {"DATE": None}, {"DATE": "05-Mar-21"})
    (inbox / "bad.zip").write_bytes(b"no archive")
    first = jobs.clean_job(spark, str(inbox), home, inputs["meridians"])
    assert (first.archives, first.failed) == (["a.zip"], ["bad.zip"])
    assert first.months == ["2021-03", "2021-04", None]
    jobs.meta_job(spark, home, inputs["codes"], flags, inputs["restricted"])
    old = sinks.published(spark, f"{home}/published/chemicals")
    assert old.count() == 2

    archive(inbox, "b", {"POUNDS_CHEMICAL_APPLIED": "1000", "SITE_CODE": "8"}, {"DATE": "07-MAY-21"})
    archive(inbox, "bad", {"DATE": "09-JUN-21"})  # delivered again, readable now
    # a month that the new archives do not touch is not read again
    shutil.rmtree(f"{home}/fact/monthyear=2021-04")
    second = jobs.clean_job(spark, str(inbox), home, inputs["meridians"])
    assert (second.archives, second.failed) == (["b.zip", "bad.zip"], [])
    assert second.months == ["2021-03", "2021-05", "2021-06"]
    tables = jobs.meta_job(spark, home, inputs["codes"], flags, inputs["restricted"])
    expected = whole(spark, inbox, inputs)
    for name, table in expected.items():
        assert rows(tables[name], *table.columns) == rows(table) != []
    assert rows(tables["categories"], "chem_code") == [("253",)]
    # who still reads the version before is not cut off
    assert old.count() == 2
    assert jobs.clean_job(spark, str(inbox), home, inputs["meridians"]) == jobs.Ingested([], [], [])
    assert sorted(r[0] for r in sinks.read_ledger(spark, f"{home}/ledger").collect()) == ["a.zip", "b.zip", "bad.zip"]


def test_a_run_that_dies_before_the_ledger_is_done_over(spark, tmp_path, inputs, monkeypatch):
    inbox, home = tmp_path / "in", str(tmp_path / "home")
    inbox.mkdir()
    archive(inbox, "a", {}, {}, {"DATE": "07-APR-21"})

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "append_ledger", dies)
        with pytest.raises(OSError):
            jobs.clean_job(spark, str(inbox), home, inputs["meridians"])
    jobs.clean_job(spark, str(inbox), home, inputs["meridians"])
    assert jobs.clean_fact(spark, home).count() == 3
    assert rows(jobs.clean_fact(spark, home), "year", "archive")[0] == (2021, "a.zip")
    made = rows(jobs.stored_months(spark, home).where("table = 'chemicals'"), "monthyear", "_lbs")
    assert made == [("2021-03", 25.0), ("2021-04", 12.5)]


def test_units_are_published_and_checked(spark, tmp_path, inputs):
    inbox, home = tmp_path / "in", str(tmp_path / "home")
    inbox.mkdir()
    archive(inbox, "a", {}, {"CHEMICAL_CODE": "12"}, {"DATE": "07-APR-21", "USE_NUMBER": "2"})
    jobs.clean_job(spark, str(inbox), home, inputs["meridians"])
    categories = spark.createDataFrame([("253", "OP", "4", "")], "chem_code string, major_category string, ai_type string, health string")
    jobs.publish_all(spark, home, {"categories": categories})
    tables = jobs.unit_job(spark, home, inputs["walks"], inputs["fips"])
    assert set(tables) == {"tract", "school", "zip", "county", "township", "section", "reconciliation"}
    assert all(tables[n].count() == 3 for n in ("tract", "county", "section"))
    assert {r["diff"] for r in tables["reconciliation"].collect()} == {0.0}
    assert COLUMNS and "use_index" in tables["tract"].columns

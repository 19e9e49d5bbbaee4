"""Area tables hold every area, with or without use."""

from pyspark.sql import functions as F

from arealytics.catalog import areas  # noqa: F401  (registers the queries)
from arealytics.catalog.registry import QUERIES
from arealytics.catalog.views import Inputs
from arealytics.plans import demography
from arealytics.specs import COUNTS, INCOME

FOLDER = "/root/testdata/sf0.001"


class OneSection(Inputs):
    """All sections, but reports of a single one only."""

    def __call__(self, name):
        df = super().__call__(name)
        if name != "use_raw":
            return df
        one = df.where("COMTRS IS NOT NULL").agg(F.min("COMTRS")).first()[0]
        return df.where(F.col("COMTRS") == one)


def test_townships_without_use_are_listed(spark):
    found = QUERIES["usage_by_township"](OneSection(spark, FOLDER)).collect()
    sections = Inputs(spark, FOLDER)("section_meridian").collect()
    every = {f"{r.Meridian} T{r.CO_MTRS[3:6]} R{r.CO_MTRS[6:9]}" for r in sections}
    assert sorted(r.MeridianTownshipRange for r in found) == sorted(every)
    assert sum(r.lbs_chm_used is not None for r in found) <= 1 < len(every)


def test_checks_compare_every_level(spark):
    t = Inputs(spark, FOLDER)
    found = {r.title for r in QUERIES["reconcile_every_level"](t).collect()}
    assert found == {"tract", "school", "zip", "county", "township", "section"}
    found = {r.title for r in QUERIES["population_reconcile_every_level"](t).collect()}
    assert found == {"county", "school", "zip", "section", "township"}


def test_weighted_sums_do_not_depend_on_row_order(spark):
    # 40 tracts of 5 people, each a 0.0125th: 2.5 people, a tie for the rounding
    tracts = spark.range(40).select(
        F.col("id").cast("string").alias("FIPS"), *[F.lit(5).cast("long").alias(c) for c in COUNTS],
        F.lit(1000).cast("long").alias(INCOME),
    )
    shares = spark.range(40).selectExpr("'a' AS area", "CAST(id AS STRING) AS GEOID", "0.0125D AS AREA_RATIO")
    areas = spark.sql("SELECT 'a' AS area, 1.0D AS ALAND")
    found = set()
    for parts in (1, 3, 7):
        for descending in (False, True):
            order = F.desc("GEOID") if descending else F.asc("GEOID")
            pairs = shares.repartition(parts).sortWithinPartitions(order)
            found.update(demography.area_demography(areas, pairs, tracts, "area").collect())
    assert len(found) == 1 and found.pop()["Pop Total"] == 2

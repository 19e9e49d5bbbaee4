"""Demography and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arealytics.catalog.cleaning import _SQL_TOWNSHIP
from arealytics.catalog.registry import NAMED, SQL, query, rounded
from arealytics.catalog.units import enriched, use_keyed
from arealytics.catalog.views import Inputs
from arealytics.functions.text import township_range
from arealytics.operators.aggregates import option_list, quantile_bins
from arealytics.operators.crosswalk import weight
from arealytics.operators.filters import use_by_area, use_over_time, usage_filter
from arealytics.plans import demography
from arealytics.specs import (
    COUNTS,
    EMPLOYED,
    FARMING,
    GROUPS,
    INCOME,
    NO_HIGH_SCHOOL,
    OLDER_COUNTS,
    OLDER_SHARES,
    OVER_25,
    POPULATION,
    POPULATION_TOTALS,
    SCHOOL,
    SHORT_NAMES,
    TRACT,
)

_SHORT = {full: short for short, full in SHORT_NAMES.items()}


# --------------------------------------------------------------------------
# SQL pieces
# --------------------------------------------------------------------------


def _share(part: str, whole: str) -> str:
    return f"round_even((CAST(\"{part}\" AS DOUBLE) / nullif(\"{whole}\", 0)) * 100e0, 3)"


def _sql_standard(source: str, area: str, keep: str = "", short: bool = False) -> str:
    def n(column: str) -> str:
        return _SHORT.get(column, column) if short else column

    groups = ", ".join(
        f'"{n(c)}" AS "Pop {g}", {_share(n(c), POPULATION)} AS "Pct {g}"'
        for g, c in GROUPS
    )
    return (
        f'SELECT "{area}", round_even("{INCOME}", 0) AS "Median HH Income",'
        f' "{POPULATION}" AS "Pop Total", {groups},'
        f' {_share(n(NO_HIGH_SCHOOL), n(OVER_25))} AS "Pct No High School",'
        f' {_share(n(FARMING), n(EMPLOYED))} AS "Pct Agriculture"{keep} FROM {source}'
    )


def _sql_guarded(source: str, area: str) -> str:
    shares = ", ".join(
        f'CAST(round_even(CASE WHEN "{POPULATION}" = 0 THEN 0e0 ELSE'
        f' round_even(CAST("{c}" AS DOUBLE) / "{POPULATION}", 4) END * 100e0, 0) AS BIGINT) AS {n}'
        for n, c in OLDER_SHARES
    )
    return f'SELECT "{area}", "{INCOME}" AS median_hh, {shares} FROM {source}'


NAMED["guarded_tracts"] = _sql_guarded("tract_survey", "FIPS")
NAMED["tract_figures"] = _sql_standard("tract_survey", "FIPS")
NAMED["tract_table"] = (
    'SELECT DISTINCT f.*, "GEOID", "ALAND", "AWATER", "NAMELSAD" || \' \' || "NAMELSADCO" AS "Area Name"'
    ' FROM tract_geo g JOIN tract_figures f ON g."GEOID" = f."FIPS"'
)
NAMED["county_figures"] = _sql_standard(
    "county_survey", "FIPS", ', "Area Name", ordinal', short=True
)
NAMED["county_table"] = (
    'SELECT DISTINCT f.* EXCLUDE (ordinal), CAST("ALAND" AS BIGINT) AS "ALAND", CAST("AWATER" AS BIGINT) AS "AWATER"'
    " FROM county_figures f JOIN county_geo g ON f.ordinal = CAST(g.county_cd AS BIGINT)"
)
NAMED["school_figures"] = _sql_standard("elementary", "FIPS", ', "Area Name"', short=True)
NAMED["zip_figures"] = _sql_standard("zip_survey", "GEOID")


def _sql_shared(counts: list[str]) -> str:
    sums = ", ".join(
        f'CAST(round_even(coalesce(sum(CAST("{c}" AS DECIMAL(20,3)) * CAST("AREA_RATIO" AS DECIMAL(16,12))), 0), 0) AS BIGINT)'
        f' AS "{c}"'
        for c in [*counts, INCOME]
    )
    return (
        f'SELECT "CO_MTRS" AS comtrs, {sums}, CAST(sum(CAST("AREA_RATIO" AS DECIMAL(16,12))) AS DOUBLE) AS w'
        ' FROM section_xwalk x LEFT JOIN tract_survey s ON x."GEOID" = s."FIPS"'
    )


NAMED["section_sums"] = (
    _sql_shared(COUNTS)
    + ' WHERE x."CO_MTRS" IN (SELECT comtrs FROM section_area) GROUP BY "CO_MTRS"'
)
NAMED["section_income"] = (
    f'SELECT * EXCLUDE ("{INCOME}"), "{INCOME}" / nullif(w, 0) AS "{INCOME}" FROM section_sums'
)
NAMED["section_figures"] = _sql_standard("section_income", "comtrs")
NAMED["section_table"] = (
    'SELECT f.*, a."ALAND" FROM section_figures f JOIN section_area a USING (comtrs)'
)
NAMED["section_townships"] = (
    f"""SELECT DISTINCT comtrs, "Meridian" || ' ' || ({_SQL_TOWNSHIP}) AS "MeridianTownshipRange" """
    'FROM (SELECT "CO_MTRS" AS comtrs, "Meridian" FROM section_meridian) WHERE "MeridianTownshipRange" IS NOT NULL'
)
NAMED["township_sums"] = (
    _sql_shared(COUNTS).replace('"CO_MTRS" AS comtrs', '"MeridianTownshipRange"')
    + ' JOIN section_townships ON comtrs = "CO_MTRS" GROUP BY "MeridianTownshipRange"'
)
NAMED["township_income"] = (
    f'SELECT * EXCLUDE ("{INCOME}"), "{INCOME}" / nullif(w, 0) AS "{INCOME}" FROM township_sums'
)
NAMED["township_figures"] = _sql_standard("township_income", "MeridianTownshipRange")
NAMED["township_table"] = (
    'SELECT f.*, "ALAND" FROM township_figures f JOIN (SELECT "MeridianTownshipRange", sum("ALAND") AS "ALAND"'
    ' FROM section_townships LEFT JOIN section_area USING (comtrs) GROUP BY ALL) USING ("MeridianTownshipRange")'
)
NAMED["older_sums"] = _sql_shared(OLDER_COUNTS) + ' GROUP BY "CO_MTRS"'


# --------------------------------------------------------------------------
# Demography
# --------------------------------------------------------------------------


def tract_table(t: Inputs) -> DataFrame:
    return demography.tract_demography(t("tract_survey"), t("tract_geo"))


def county_table(t: Inputs) -> DataFrame:
    return demography.county_demography(t("county_survey"), t("county_geo"), "ordinal")


def section_table(t: Inputs) -> DataFrame:
    crosswalk = t("section_xwalk").withColumnRenamed("CO_MTRS", "comtrs")
    return demography.area_demography(
        t("section_area"), crosswalk, t("tract_survey"), "comtrs"
    )


def section_townships(t: Inputs) -> DataFrame:
    """The township of each section; sections without one are left out."""
    township = F.concat(F.col("Meridian"), F.lit(" "), township_range(F.col("CO_MTRS")))
    sections = t("section_meridian").select(
        F.col("CO_MTRS").alias("comtrs"), township.alias("MeridianTownshipRange")
    )
    return sections.where(F.col("MeridianTownshipRange").isNotNull()).distinct()


def school_table(t: Inputs) -> DataFrame:
    return demography.school_demography(t("elementary"), t("school_geo"))


def zip_table(t: Inputs) -> DataFrame:
    return demography.zip_demography(t("zip_survey"), t("zip_geo"))


def township_table(t: Inputs) -> DataFrame:
    """A township is its sections: their shares of tracts and their areas."""
    sections = section_townships(t)
    areas = (
        sections.join(t("section_area"), "comtrs", "left")
        .groupBy("MeridianTownshipRange")
        .agg(F.sum("ALAND").alias("ALAND"))
    )
    crosswalk = t("section_xwalk").withColumnRenamed("CO_MTRS", "comtrs")
    return demography.area_demography(
        areas, crosswalk.join(sections, "comtrs"), t("tract_survey"), "MeridianTownshipRange"
    )


@query("demography_pct", "SELECT * FROM tract_table")
def _demography_pct(t):
    return tract_table(t)


@query("demography_pct_guarded", "SELECT * FROM guarded_tracts")
def _demography_pct_guarded(t):
    return demography.guarded_demography(t("tract_survey"), "FIPS")


@query("positional_key", "SELECT * FROM county_table")
def _positional_key(t):
    return county_table(t)


@query(
    "demography_geo",
    'SELECT DISTINCT f.*, "ALAND", "AWATER" FROM school_figures f JOIN school_geo USING ("FIPS")',
)
def _demography_geo(t):
    return school_table(t)


@query(
    "zip_demography",
    """SELECT DISTINCT f.*, "ALAND20" AS "ALAND", "AWATER20" AS "AWATER"
       FROM zip_figures f JOIN zip_geo ON "GEOID" = "ZCTA5CE20" """,
)
def _zip_demography(t):
    return zip_table(t)


@query("area_weighted_demography", "SELECT * FROM section_table")
def _area_weighted(t):
    return section_table(t)


@query("area_weighted_demography_guarded", _sql_guarded("older_sums", "comtrs"))
def _area_weighted_guarded(t):
    crosswalk = t("section_xwalk").withColumnRenamed("CO_MTRS", "comtrs")
    out = demography.area_demography_guarded(crosswalk, t("tract_survey"), "comtrs")
    return out


@query(
    "union_districts",
    """SELECT substr("FIPS", 3) AS "FIPS", * EXCLUDE ("FIPS") FROM (
         SELECT *, 'Elementary' AS "District Type" FROM elementary UNION ALL BY NAME SELECT *, 'Unified' FROM unified)
       WHERE "FIPS" <> '0699999'""".replace("'Unified' FROM", "'Unified' AS \"District Type\" FROM"),
)
def _union_districts(t):
    return demography.district_survey(t("elementary"), t("unified"))


def _sql_populations(title: str, other: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{title}' AS title, '{k}' AS measure,"
        f' (SELECT sum("{c}") FROM tract_table) AS b, (SELECT sum("{c}") FROM {other}) AS d'
        for k, c in POPULATION_TOTALS
    )


@query(
    "population_reconcile",
    f"""SELECT title, measure, CAST(b AS DOUBLE) AS base, CAST(d AS DOUBLE) AS derived, CAST(b - d AS DOUBLE) AS diff,
          round_even(CAST(b - d AS DOUBLE) / nullif(b, 0), 4) * 100e0 AS pct FROM (
        {_sql_populations("county", "county_table")} UNION ALL {_sql_populations("section", "section_table")})""",
)
def _population_reconcile(t):
    return demography.population_reconcile(
        tract_table(t), {"county": county_table(t), "section": section_table(t)}
    )


@query("township_demography", "SELECT * FROM township_table")
def _township_demography(t):
    return township_table(t)


NAMED["school_table"] = SQL["demography_geo"]
NAMED["zip_table"] = SQL["zip_demography"]


@query(
    "population_reconcile_every_level",
    f"""SELECT title, measure, CAST(b AS DOUBLE) AS base, CAST(d AS DOUBLE) AS derived, CAST(b - d AS DOUBLE) AS diff,
          round_even(CAST(b - d AS DOUBLE) / nullif(b, 0), 4) * 100e0 AS pct FROM (
        {" UNION ALL ".join(_sql_populations(x, f"{x}_table") for x in ("county", "school", "zip", "section", "township"))})""",
)
def _population_reconcile_every_level(t):
    others = {
        "county": county_table(t),
        "school": school_table(t),
        "zip": zip_table(t),
        "section": section_table(t),
        "township": township_table(t),
    }
    return demography.population_reconcile(tract_table(t), others)


# --------------------------------------------------------------------------
# Dashboard
# --------------------------------------------------------------------------

_PARAMS = {
    "start": "2016-03",
    "end": "2020-10",
    "usetype": "AG",
    "site": ["3", "7", "11", "20", "21", "22", "35"],
    "ai_class": "*",
    "county": [],
}
_SQL_PARAMS = (
    "monthyear >= '2016-03' AND monthyear <= '2020-10' AND usetype = 'AG'"
    " AND site_code IN ('3', '7', '11', '20', '21', '22', '35')"
)


@query("usage_filtered", f"SELECT * FROM use_keyed WHERE {_SQL_PARAMS}")
def _usage_filtered(t):
    return usage_filter(use_keyed(t), _PARAMS)


def _series(name: str, by: str, period: str) -> None:
    date = "monthyear" if period == "month" else "left(monthyear, 4)"

    @query(
        name,
        f"""SELECT {date} AS date, {by}, round(sum(lbs_chm_used), 4) AS lbs_chm_used FROM enriched_use
            WHERE monthyear >= '2017-01' AND monthyear <= '2021-12' GROUP BY ALL""",
    )
    def _build(t):
        out = use_over_time(
            enriched(t), by, period, {"start": "2017-01", "end": "2021-12"}
        )
        return rounded(out, {"lbs_chm_used": 4})


_series("monthly_by_group", "usetype", "month")
_series("monthly_by_class", "major_category", "month")
_series("monthly_by_type", "ai_type", "month")
_series("yearly_by_group", "usetype", "year")
_series("yearly_by_class", "major_category", "year")
_series("yearly_by_type", "ai_type", "year")

_LBS = {"lbs_chm_used": 4, "lbs_prd_used": 4}
_SQL_SUMS = "round(sum(lbs_chm_used), 4) AS lbs_chm_used, round(sum(lbs_prd_used), 4) AS lbs_prd_used"


def tract_use(t: Inputs, params: dict) -> DataFrame:
    fact = weight(use_keyed(t), t("section_xwalk"), TRACT)
    areas = tract_table(t).select("GEOID", "Area Name", "Pct Hispanic", "Median HH Income")
    return use_by_area(fact, areas, "GEOID", params)


NAMED["tract_use"] = (
    'SELECT a."GEOID", "Area Name", "Pct Hispanic", "Median HH Income", lbs_chm_used, lbs_prd_used FROM tract_table a'
    f' LEFT JOIN (SELECT "GEOID", {_SQL_SUMS} FROM weighted_use WHERE monthyear >= \'2016-01\' GROUP BY "GEOID") USING ("GEOID")'
)


@query(
    "usage_by_area",
    """SELECT * FROM tract_use WHERE "Pct Hispanic" >= 5 AND "Median HH Income" >= 40000""",
)
def _usage_by_area(t):
    out = tract_use(t, {"start": "2016-01", "pcthispanic": 5, "income": 40000})
    return rounded(out, _LBS)


@query(
    "usage_by_county",
    f"""SELECT c."FIPS", n_name AS name, lbs_chm_used, lbs_prd_used FROM county_xwalk c
        JOIN nation ON CAST(n_nationkey + 1 AS VARCHAR) = "DPR_ID"
        LEFT JOIN (SELECT county_cd, {_SQL_SUMS} FROM use_keyed WHERE monthyear <= '2019-12' GROUP BY county_cd) ON county_cd = "DPR_ID" """,
)
def _usage_by_county(t):
    areas = (
        t("county_xwalk")
        .join(
            t("nation").selectExpr("CAST(n_nationkey + 1 AS STRING) AS DPR_ID", "n_name AS name"),
            "DPR_ID",
        )
        .withColumnRenamed("DPR_ID", "county_cd")
    )
    out = use_by_area(use_keyed(t), areas, "county_cd", {"end": "2019-12"})
    return rounded(out.drop("county_cd"), _LBS)


def townships(t: Inputs) -> DataFrame:
    """The townships of all sections, with or without use."""
    return section_townships(t).select("MeridianTownshipRange").distinct()


@query(
    "usage_by_township",
    f"""SELECT "MeridianTownshipRange", lbs_chm_used, lbs_prd_used
        FROM (SELECT DISTINCT "MeridianTownshipRange" FROM section_townships)
        LEFT JOIN (SELECT "MeridianTownshipRange", {_SQL_SUMS} FROM use_keyed WHERE usetype = 'AG'
                   GROUP BY "MeridianTownshipRange") USING ("MeridianTownshipRange")""",
)
def _usage_by_township(t):
    out = use_by_area(
        use_keyed(t), townships(t), "MeridianTownshipRange", {"usetype": "AG"}
    )
    return rounded(out, _LBS)


@query(
    "usage_by_school",
    f"""SELECT "FIPS", lbs_chm_used, lbs_prd_used FROM (SELECT DISTINCT "FIPS" FROM section_xwalk)
        LEFT JOIN (SELECT "FIPS", {_SQL_SUMS} FROM (
            SELECT "FIPS", monthyear, lbs_chm_used * "AREA_RATIO" AS lbs_chm_used, lbs_prd_used * "AREA_RATIO" AS lbs_prd_used
            FROM use_keyed u JOIN section_xwalk ON comtrs = "CO_MTRS" WHERE u.usetype = 'AG')
          WHERE monthyear >= '2017-01' AND "FIPS" NOT IN ('00007') GROUP BY "FIPS") USING ("FIPS")""",
)
def _usage_by_school(t):
    fact = weight(use_keyed(t), t("section_xwalk"), SCHOOL).where("FIPS <> '00007'")
    areas = t("section_xwalk").select("FIPS").distinct()
    return rounded(use_by_area(fact, areas, "FIPS", {"start": "2017-01"}), _LBS)


@query(
    "usage_filtered_school",
    """SELECT use_id, monthyear, "FIPS", round(lbs_chm_used * "AREA_RATIO", 6) AS lbs_chm_used
       FROM use_keyed u JOIN section_xwalk ON comtrs = "CO_MTRS"
       WHERE u.usetype = 'AG' AND "FIPS" IN ('00011', '00014') AND monthyear >= '2017-01'""",
)
def _usage_filtered_school(t):
    fact = weight(use_keyed(t), t("section_xwalk"), SCHOOL)
    wanted = {"schooldistrict": ["00011", "00014"], "start": "2017-01", "tract": "*"}
    out = usage_filter(fact, wanted).select("use_id", "monthyear", "FIPS", "lbs_chm_used")
    return rounded(out, {"lbs_chm_used": 6})


@query(
    "usage_filtered_tract",
    """SELECT use_id, monthyear, "GEOID", round(lbs_chm_used, 6) AS lbs_chm_used FROM weighted_use
       WHERE "GEOID" IN (SELECT max("GEOID") FROM section_xwalk)""",
)
def _usage_filtered_tract(t):
    fact = weight(use_keyed(t), t("section_xwalk"), TRACT)
    chosen = t("section_xwalk").agg(F.max("GEOID")).first()[0]  # one code
    out = usage_filter(fact, {"tract": [chosen]}).select(
        "use_id", "monthyear", "GEOID", "lbs_chm_used"
    )
    return rounded(out, {"lbs_chm_used": 6})


@query(
    "option_list",
    """SELECT DISTINCT chem_code AS value, chemname AS label FROM chemical
       ORDER BY label NULLS LAST, value LIMIT 50""",
)
def _option_list(t):
    return option_list(t("chemical"), "chem_code", "chemname")


@query(
    "quantile_bins",
    """SELECT "GEOID", lbs_chm_used, CASE WHEN lbs_chm_used IS NOT NULL AND lbs_chm_used <> 0 THEN
         CAST(1 + (lbs_chm_used >= q[1])::INT + (lbs_chm_used >= q[2])::INT + (lbs_chm_used >= q[3])::INT + (lbs_chm_used >= q[4])::INT AS INT) END AS bin
       FROM tract_use, (SELECT quantile_cont(lbs_chm_used, [0.2, 0.4, 0.6, 0.8]) AS q FROM tract_use WHERE lbs_chm_used <> 0)""",
)
def _quantile_bins(t):
    out = rounded(tract_use(t, {"start": "2016-01"}), _LBS)
    return quantile_bins(out.select("GEOID", "lbs_chm_used"), "lbs_chm_used")

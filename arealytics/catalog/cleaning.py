"""Ingest and cleaning queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from arealytics.catalog.registry import NAMED, SQL, query
from arealytics.catalog.views import Inputs
from arealytics.functions import dates, numbers, text
from arealytics.operators.aggregates import assign_file_year, file_year
from arealytics.operators.filters import drop_null
from arealytics.operators.keys import use_id
from arealytics.plans import clean, older
from arealytics.session import shared_folder
from arealytics.sinks import pending_files
from arealytics.sources.reports import read_ragged_years, union_years
from arealytics.sources.tables import drop_header_rows, harvest_links
from arealytics.specs import (
    CODE_BLANKS,
    CODES,
    MEASURE_BLANKS,
    MEASURES,
    REPORT_COLUMNS,
)


def raw(t: Inputs) -> DataFrame:
    return drop_null(t("use_raw"), "DATE")


def use_fact(t: Inputs) -> DataFrame:
    return clean.clean_use(raw(t), t("section_meridian"))


_RAW_OF = {b: a for a, b in REPORT_COLUMNS.items()}


def _sql_number(column: str) -> str:
    return (
        f"coalesce(CAST(CASE WHEN {column} IN ('', 'nan', 'MARCH', 'ACRES')"
        f" THEN NULL ELSE {column} END AS DOUBLE), 0)"
    )


def _sql_code(column: str) -> str:
    return (
        f"CAST(CAST(trunc(coalesce(TRY_CAST(CASE WHEN {column} IN ('', 'GA')"
        f" THEN NULL ELSE {column} END AS DOUBLE), 0)) AS BIGINT) AS VARCHAR)"
    )


def _sql_clean(name: str) -> str:
    source = f'"{_RAW_OF[name]}"'
    if name in MEASURES:
        return f"{_sql_number(source)} AS {name}"
    if name in CODES:
        return f"{_sql_code(source)} AS {name}"
    return f"{source} AS {name}"


_SQL_MONTH = (
    "'20' || right(date, 2) || '-' || CASE substr(date, 4, 3)"
    " WHEN 'JAN' THEN '01' WHEN 'FEB' THEN '02' WHEN 'MAR' THEN '03'"
    " WHEN 'APR' THEN '04' WHEN 'MAY' THEN '05' WHEN 'JUN' THEN '06'"
    " WHEN 'JUL' THEN '07' WHEN 'AUG' THEN '08' WHEN 'SEP' THEN '09'"
    " WHEN 'OCT' THEN '10' WHEN 'NOV' THEN '11' WHEN 'DEC' THEN '12' END"
)
_SQL_TOWNSHIP = (
    "CASE WHEN length(comtrs) >= 9 THEN"
    " 'T' || substr(comtrs, 4, 3) || ' R' || substr(comtrs, 7, 3) END"
)
_SQL_USE_ID = (
    "monthyear || coalesce(use_number, 'nan') || printf('%.14e', lbs_prd_used)"
    " || CASE WHEN lbs_prd_used - CAST(printf('%.14e', lbs_prd_used) AS DOUBLE) <> 0"
    " THEN printf('%+.14e', lbs_prd_used - CAST(printf('%.14e', lbs_prd_used) AS DOUBLE)) ELSE '' END"
    " || coalesce(comtrs, 'nan')"
)

NAMED["use_clean"] = (
    f"SELECT {', '.join(map(_sql_clean, REPORT_COLUMNS.values()))}"
    ' FROM use_raw WHERE "DATE" IS NOT NULL'
)
NAMED["use_fact"] = (
    f"SELECT c.* EXCLUDE (date), {_SQL_MONTH} AS monthyear,"
    f""" m."Meridian" || ' ' || ({_SQL_TOWNSHIP}) AS "MeridianTownshipRange" """
    'FROM use_clean c LEFT JOIN section_meridian m ON c.comtrs = m."CO_MTRS"'
)
NAMED["use_keyed"] = f"SELECT *, {_SQL_USE_ID} AS use_id FROM use_fact"


@query(
    "union_years",
    f"""SELECT {", ".join(f'"{c}"' for c in REPORT_COLUMNS)} FROM use_raw""",
)
def _union_years(t):
    df = t("use_raw")
    year = F.col("YEAR")
    parts = [df.where(year < 2018), df.where(year >= 2018), df.where(year.isNull())]
    return union_years(parts, list(REPORT_COLUMNS))


@query("drop_null_dates", 'SELECT * FROM use_raw WHERE "DATE" IS NOT NULL')
def _drop_null_dates(t):
    return raw(t)


@query(
    "rename_keep",
    f"""SELECT {", ".join(f'"{a}" AS {b}' for a, b in REPORT_COLUMNS.items())} FROM use_raw""",
)
def _rename_keep(t):
    return clean.rename_keep(t("use_raw"))


@query(
    "clean_numeric",
    f"SELECT {', '.join(_sql_clean(c) for c in MEASURES)} FROM use_raw",
)
def _clean_numeric(t):
    df = clean.rename_keep(t("use_raw"))
    return numbers.clean_numeric(df, MEASURES, MEASURE_BLANKS).select(*MEASURES)


@query("clean_code", f"SELECT {', '.join(_sql_clean(c) for c in CODES)} FROM use_raw")
def _clean_code(t):
    df = clean.rename_keep(t("use_raw"))
    return numbers.clean_code(df, CODES, CODE_BLANKS).select(*CODES)


@query(
    "coerce_numeric",
    """SELECT "USE_NUMBER", CASE WHEN NOT isnan(a) THEN a END AS "POUNDS_CHEMICAL_APPLIED",
       CASE WHEN NOT isnan(b) THEN b END AS "CHEMICAL_CODE"
       FROM (SELECT "USE_NUMBER", TRY_CAST("POUNDS_CHEMICAL_APPLIED" AS DOUBLE) AS a,
             TRY_CAST("CHEMICAL_CODE" AS DOUBLE) AS b FROM use_raw)""",
)
def _coerce_numeric(t):
    columns = ["POUNDS_CHEMICAL_APPLIED", "CHEMICAL_CODE"]
    df = t("use_raw").select("USE_NUMBER", *columns)
    return numbers.coerce_numeric(df, columns)


@query(
    "numeric_if_all",
    """SELECT "USE_NUMBER", "POUNDS_CHEMICAL_APPLIED", CAST("AMOUNT_PLANTED" AS DOUBLE) AS "AMOUNT_PLANTED",
       CAST("PRODUCT_CHEMICAL_PERCENT" AS DOUBLE) AS "PRODUCT_CHEMICAL_PERCENT", "ADJUVANT" FROM use_raw""",
)
def _numeric_if_all(t):
    df = t("use_raw").select(
        "USE_NUMBER",
        "POUNDS_CHEMICAL_APPLIED",
        "AMOUNT_PLANTED",
        "PRODUCT_CHEMICAL_PERCENT",
        "ADJUVANT",
    )
    return numbers.numeric_if_all(df, ["USE_NUMBER"])


@query(
    "fill_defaults",
    """SELECT coalesce("COMTRS", '') AS "COMTRS", coalesce("AERIAL_GROUND_INDICATOR", '') AS "AERIAL_GROUND_INDICATOR",
       coalesce("YEAR", 0) AS "YEAR" FROM use_raw""",
)
def _fill_defaults(t):
    df = t("use_raw").select("COMTRS", "AERIAL_GROUND_INDICATOR", "YEAR")
    return numbers.fill_defaults(df, ["YEAR"])


@query(
    "file_year_mode",
    """SELECT _file, "YEAR", rows_of_file FROM (
         SELECT _file, "YEAR", row_number() OVER (PARTITION BY _file ORDER BY count(*) DESC, "YEAR") AS rn
         FROM use_raw WHERE "YEAR" IS NOT NULL GROUP BY _file, "YEAR")
       JOIN (SELECT _file, count(*) AS rows_of_file FROM use_raw GROUP BY _file) USING (_file)
       WHERE rn = 1""",
)
def _file_year_mode(t):
    assigned = assign_file_year(t("use_raw").select("_file", "YEAR"), "_file")
    return assigned.groupBy("_file", "YEAR").agg(
        F.count(F.lit(1)).alias("rows_of_file")
    )


@query(
    "file_year_ties",
    """SELECT region, "YEAR" FROM (
         SELECT s_nationkey AS region, "YEAR", row_number() OVER (PARTITION BY s_nationkey ORDER BY count(*) DESC, "YEAR") AS rn
         FROM (SELECT s_nationkey, CAST(s_suppkey % 3 AS INT) AS "YEAR" FROM supplier) GROUP BY s_nationkey, "YEAR")
       WHERE rn = 1""",
)
def _file_year_ties(t):
    df = t("supplier").selectExpr(
        "s_nationkey AS region", "CAST(s_suppkey % 3 AS INT) AS YEAR"
    )
    return file_year(df, "region")


@query(
    "month_year",
    f"""SELECT date, {_SQL_MONTH} AS monthyear, left({_SQL_MONTH}, 4) AS year,
        substr({_SQL_MONTH}, 6, 2) AS month,
        strftime(TRY_STRPTIME(date, '%d-%b-%y'), '%Y-%m') AS parsed
        FROM (SELECT "DATE" AS date FROM use_raw)""",
)
def _month_year(t):
    df = t("use_raw").select(F.col("DATE").alias("date"))
    month = dates.month_year(F.col("date"))
    return df.select(
        "date",
        month.alias("monthyear"),
        dates.year_of(month).alias("year"),
        dates.month_of(month).alias("month"),
        dates.parsed_month(F.col("date")).alias("parsed"),
    )


@query(
    "township_range",
    f"""SELECT comtrs, {_SQL_TOWNSHIP} AS township FROM (SELECT "COMTRS" AS comtrs FROM use_raw)""",
)
def _township_range(t):
    df = t("use_raw").select(F.col("COMTRS").alias("comtrs"))
    return df.withColumn("township", text.township_range(F.col("comtrs")))


@query(
    "meridian_township",
    'SELECT comtrs, use_number, "MeridianTownshipRange" FROM use_fact',
)
def _meridian_township(t):
    return use_fact(t).select("comtrs", "use_number", "MeridianTownshipRange")


@query("clean_use", "SELECT * FROM use_fact")
def _clean_use(t):
    return use_fact(t)


@query("use_id", f"SELECT {_SQL_USE_ID} AS use_id FROM use_fact")
def _use_id(t):
    return use_fact(t).select(use_id().alias("use_id"))


@query(
    "skip_header_row",
    """SELECT "FIPS", "Area Name", "Total Population" FROM county_survey
       WHERE "Area Name" <> 'Customer#000000000'""",
)
def _skip_header_row(t):
    survey = drop_header_rows(t("county_survey"), "Area Name", ["Customer#000000000"])
    return survey.select("FIPS", "Area Name", "Total Population")


@query(
    "link_harvest",
    r"""SELECT page_id, CAST(position AS INT) AS position, href, split_part(href, '/', -1) AS name FROM (
          SELECT page_id, unnest(links) AS href, unnest(range(len(links))) AS position FROM (
            SELECT page_id, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"''>]*)["'']', 1) AS links
            FROM pages)) WHERE contains(href, '/th')""",
)
def _link_harvest(t):
    return harvest_links(t("pages"), "/th")


@query(
    "pending_files",
    """SELECT DISTINCT name FROM (SELECT strftime(l_shipdate, 'use_%Y-%m.parquet') AS name FROM lineitem
         UNION ALL SELECT CASE WHEN l_linenumber > 0 THEN 'use_full.parquet' END FROM lineitem)
       WHERE name = 'use_full.parquet' OR name NOT IN (
         SELECT strftime(o_orderdate, 'use_%Y-%m.parquet') FROM orders GROUP BY 1 HAVING count(*) % 2 = 0)""",
)
def _pending_files(t):
    def named(day):
        return F.concat(F.lit("use_"), F.date_format(day, "yyyy-MM"), F.lit(".parquet"))

    months = t("lineitem").select(named("l_shipdate").alias("name"))
    full = t("lineitem").select(F.lit("use_full.parquet").alias("name"))
    present = (
        t("orders")
        .groupBy(named("o_orderdate").alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows % 2 = 0")
    )
    return pending_files(months.union(full), present, "use_full.parquet")


@query(
    "older_use",
    """SELECT use_no, comtrs, county, lbs_chm_used, date, CAST(year(date) AS INT) AS year,
         CASE WHEN comtrs IS NOT NULL THEN 'ag' ELSE 'nonag' END AS usetype, "FIPS", "Name"
       FROM (SELECT use_no, comtrs, '06' || lpad(county_cd, 3, '0') AS county, lbs_chm_used,
               CAST(TRY_STRPTIME(applic_dt, '%m/%d/%Y') AS DATE) AS date FROM old_use)
       LEFT JOIN (SELECT CASE WHEN length("CountyCode") < 5 THEN lpad("CountyCode", 5, '0') ELSE "CountyCode" END AS code,
               lpad("FIPS", 5, '0') AS "FIPS", "Name" FROM old_county) ON code = county
       WHERE date >= DATE '2017-01-01'""",
)
def _older_use(t):
    found = older.older_use(t("old_use"), t("old_county"))
    return found.withColumnRenamed("county_cd", "county")


NAMED["section_keys"] = (
    'SELECT "CO_MTRS", min("GEOID") AS "GEOID", min("ZCTA5CE20") AS "ZIP" FROM section_xwalk GROUP BY "CO_MTRS"'
)


@query(
    "older_use_keys",
    f"""SELECT u.*, "GEOID", "ZIP" FROM ({SQL["older_use"]}) u LEFT JOIN section_keys ON comtrs = "CO_MTRS" """,
)
def _older_use_keys(t):
    keys = t("section_xwalk").groupBy("CO_MTRS").agg(
        F.min("GEOID").alias("GEOID"), F.min("ZCTA5CE20").alias("ZIP")
    )
    found = older.older_use(t("old_use"), t("old_county"), keys=keys)
    return found.withColumnRenamed("county_cd", "county")


@query(
    "ragged_years",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "order", CASE WHEN y % 2 = 0 THEN o_orderstatus END AS status,
         CASE WHEN y % 2 = 1 THEN o_orderpriority END AS priority, CAST(y AS INT) AS _year
       FROM (SELECT *, year(o_orderdate) AS y FROM orders) WHERE y <> 1995""",
)
def _ragged_years(t):
    """Orders written as one folder of text per year, of two layouts, and read
    back; one year is missing."""
    folder = f"{shared_folder(t.spark)}/ragged/{uuid.uuid4().hex}"
    rows = t("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS `order`", "o_orderstatus AS status",
        "o_orderpriority AS priority", "year(o_orderdate) AS year",
    ).where("year <> 1995")
    for odd, other in ((0, "priority"), (1, "status")):
        layout = rows.where(F.col("year") % 2 == odd).drop(other)
        layout.write.mode("append").partitionBy("year").option("header", True).csv(folder)
    return read_ragged_years(t.spark, folder + "/year={year}/*.csv", range(1992, 2030))


@query(
    "zip_county",
    """SELECT "ZCTA5CE20", name, "ZIP", "COUNTY" FROM zip_area JOIN (
         SELECT lpad("ZIP", 5, '0') AS "ZIP", lpad("COUNTY", 5, '0') AS "COUNTY" FROM zip_county)
       ON "ZIP" = "ZCTA5CE20" WHERE "COUNTY" LIKE '06%'""",
)
def _zip_county(t):
    return older.state_zips(t("zip_area"), t("zip_county"))


@query(
    "zip_survey_ids",
    """SELECT name, CASE WHEN len(string_split(name, ' ')) >= 2 THEN string_split(name, ' ')[2] END AS "GEOID"
       FROM (SELECT p_name AS name FROM part)""",
)
def _zip_survey_ids(t):
    return older.zip_survey_ids(t("part").select(F.col("p_name").alias("name")), "name")


@query(
    "district_id",
    """SELECT c_custkey, substr(coalesce(elsd, unsd), 3) AS district FROM (
         SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '06' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS elsd,
                CASE WHEN c_custkey % 4 <> 0 THEN '06' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS unsd FROM customer)""",
)
def _district_id(t):
    df = t("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 3 = 0 THEN '06' || lpad(CAST(c_custkey AS STRING), 5, '0') END AS elsd",
        "CASE WHEN c_custkey % 4 <> 0 THEN '06' || lpad(CAST(c_nationkey AS STRING), 5, '0') END AS unsd",
    )
    return df.select(
        "c_custkey", text.district_id(F.col("elsd"), F.col("unsd")).alias("district")
    )


@query(
    "string_predicates",
    """SELECT "DATE", "COMTRS", "AG_NONAG" FROM use_raw
       WHERE starts_with("COMTRS", '0') AND length("COMTRS") > 0 AND trim("COMTRS") <> '' AND "AG_NONAG" = 'AG'
         AND "ADJUVANT" <> 'Y'""",
)
def _string_predicates(t):
    section = F.col("COMTRS")
    return (
        t("use_raw")
        .where(section.startswith("0"))
        .where((F.length(section) > 0) & (F.trim(section) != ""))
        .where((F.col("AG_NONAG") == "AG") & (F.col("ADJUVANT") != "Y"))
        .select("DATE", "COMTRS", "AG_NONAG")
    )


@query("distinct_rows", 'SELECT DISTINCT "PRODUCT_NUMBER", "CHEMICAL_CODE" FROM use_raw')
def _distinct_rows(t):
    return t("use_raw").select("PRODUCT_NUMBER", "CHEMICAL_CODE").distinct()

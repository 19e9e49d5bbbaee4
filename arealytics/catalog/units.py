"""Dimension, crosswalk and unit-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arealytics.catalog.cleaning import use_fact
from arealytics.catalog.registry import NAMED, query, rounded
from arealytics.catalog.views import Inputs
from arealytics.functions.text import label_count, label_string
from arealytics.operators.aggregates import distinct_pair_sum, use_stats
from arealytics.operators.crosswalk import apportion, normalize_ratios, weight
from arealytics.operators.joins import keep_known
from arealytics.operators.keys import (
    dense_index,
    first_per_key,
    first_row_id,
    use_id,
)
from arealytics.plans import demography, dimensions, units
from arealytics.session import give_back, pin
from arealytics.specs import (
    CHEMICALS,
    CLASSES,
    HEALTH,
    PRODUCTS,
    SCHOOL,
    SECTION,
    SITES,
    TOWNSHIP,
    TRACT,
    ZIP,
    DimensionSpec,
    Label,
)


def use_keyed(t: Inputs) -> DataFrame:
    return use_fact(t).withColumn("use_id", use_id())


def active_flags(t: Inputs, fact: DataFrame | None = None) -> DataFrame:
    flags = dimensions.flag_restricted(t("chem_flags"), t("restricted"))
    fact = use_fact(t) if fact is None else fact
    return keep_known(flags, "chem_code", fact, "chem_code")


def categories(t: Inputs, fact: DataFrame | None = None) -> DataFrame:
    return dimensions.categories(active_flags(t, fact))


def enriched(t: Inputs) -> DataFrame:
    # the unit tables read the enriched fact several times and start from it as a
    # stored table; the cleaned fact and the categories are stored on the way
    fact = pin(use_fact(t))
    base = pin(units.enrich(fact, pin(categories(t, fact))))
    give_back(fact)
    return base


def with_demography(t: Inputs, fact: DataFrame) -> DataFrame:
    figures = demography.guarded_demography(t("tract_survey"), "FIPS")
    return units.fact_with_demography(fact, figures, "GEOID", "FIPS")


# --------------------------------------------------------------------------
# SQL pieces
# --------------------------------------------------------------------------


def _sql_labels(labels: list[Label]) -> str:
    parts = ", ".join(
        "CASE WHEN "
        + " OR ".join(f"""coalesce("{c}" = 'Y', false)""" for c in x.flags)
        + f" THEN '{x.id}' END"
        for x in labels
    )
    return f"concat_ws('|', {parts})"


NAMED["restricted_code"] = (
    "SELECT CAST(CAST(trunc(v) AS BIGINT) AS VARCHAR) AS code, 'Y' AS \"Restricted Material\""
    " FROM (SELECT TRY_CAST(chem_code AS DOUBLE) AS v FROM restricted) WHERE v IS NOT NULL"
)
NAMED["flag_rows"] = (
    'SELECT f.* EXCLUDE ("CHEM_CODE", "AI_TYPE"), f."CHEM_CODE" AS chem_code, f."AI_TYPE" AS ai_type,'
    ' r."Restricted Material" FROM chem_flags f LEFT JOIN restricted_code r ON f."CHEM_CODE" = r.code'
)
NAMED["active_flag_rows"] = (
    "SELECT * FROM flag_rows WHERE chem_code IN (SELECT chem_code FROM use_fact)"
)
NAMED["ingredient_types"] = (
    'SELECT ai_type AS kind, min(ordinal) AS "ai_type_ID" FROM active_flag_rows'
    " WHERE ai_type IS DISTINCT FROM 'ADJUVANT' GROUP BY ai_type"
)
NAMED["category_rows"] = (
    f"SELECT DISTINCT chem_code, {_sql_labels(CLASSES)} AS major_category,"
    f' CAST("ai_type_ID" AS VARCHAR) AS ai_type, {_sql_labels(HEALTH)} AS health'
    " FROM active_flag_rows JOIN ingredient_types ON ai_type IS NOT DISTINCT FROM kind"
)
NAMED["enriched_use"] = (
    "SELECT u.* EXCLUDE (use_number), c.major_category, c.ai_type, c.health"
    " FROM use_keyed u LEFT JOIN category_rows c ON u.chem_code = c.chem_code"
)


# --------------------------------------------------------------------------
# Statistics and code tables
# --------------------------------------------------------------------------

_STATS = {
    "lbs_chm_used": 4,
    "yearly_average": 4,
    "monthly_high": 4,
    "monthly_average": 4,
}


def _sql_stats(column: str) -> str:
    return f"""
      SELECT {column}, total AS lbs_chm_used, yearly_average, monthly_high, monthly_average FROM
        (SELECT {column}, sum(lbs_chm_used) AS total FROM use_fact GROUP BY {column})
        JOIN (SELECT {column}, avg(s) AS yearly_average FROM
          (SELECT {column}, left(monthyear, 4) AS y, sum(lbs_chm_used) AS s FROM use_fact
           WHERE monthyear IS NOT NULL GROUP BY ALL) GROUP BY {column}) USING ({column})
        JOIN (SELECT {column}, max(s) AS monthly_high, avg(s) AS monthly_average FROM
          (SELECT {column}, monthyear, sum(lbs_chm_used) AS s FROM use_fact
           WHERE monthyear IS NOT NULL GROUP BY ALL) GROUP BY {column}) USING ({column})"""


NAMED["chemical_stats"] = _sql_stats("chem_code")
NAMED["site_stats"] = _sql_stats("site_code")
NAMED["product_stats"] = _sql_stats("prodno")


def _sql_rounded(source: str, *others: str) -> str:
    columns = [*others, *[f"round({c}, {n}) AS {c}" for c, n in _STATS.items()]]
    return f"SELECT {', '.join(columns)} FROM {source}"


@query("use_stats", _sql_rounded("chemical_stats", "chem_code"))
def _use_stats(t):
    stats = use_stats(use_fact(t), "chem_code")
    return rounded(stats.drop("years_used", "months_used"), _STATS)


@query(
    "use_periods",
    """SELECT site_code, array_to_string(list_sort(list(DISTINCT left(monthyear, 4))), ' ') AS years_used,
         array_to_string(list_sort(list(DISTINCT monthyear)), ' ') AS months_used
       FROM use_fact WHERE monthyear IS NOT NULL GROUP BY site_code""",
)
def _use_periods(t):
    stats = use_stats(use_fact(t), "site_code")
    return stats.select(
        "site_code",
        F.array_join("years_used", " ").alias("years_used"),
        F.array_join("months_used", " ").alias("months_used"),
    )


def _dimension(t: Inputs, spec: DimensionSpec, view: str) -> DataFrame:
    return rounded(dimensions.dimension(use_fact(t), t(view), spec), _STATS)


@query(
    "use_stats_labeled",
    _sql_rounded(
        "chemical_stats JOIN chemical USING (chem_code)", "chem_code", "chemname AS chem_name"
    ),
)
def _chemicals(t):
    return _dimension(t, CHEMICALS, "chemical")


@query(
    "sites_table",
    _sql_rounded("site_stats JOIN site USING (site_code)", "site_code", "site_name"),
)
def _sites(t):
    return _dimension(t, SITES, "site")


@query(
    "products_table",
    _sql_rounded(
        "product_stats s JOIN product p ON s.prodno = p.prodno",
        "s.prodno AS prodno",
        "p.prodno AS product_code",
        "product_name",
    ),
)
def _products(t):
    return _dimension(t, PRODUCTS, "product")


@query(
    "dimension_tables",
    f"""SELECT 'chemicals' AS name, id, label, {', '.join(f'round({c}, {n}) AS {c}' for c, n in _STATS.items())} FROM
          (SELECT chem_code AS id, chemname AS label, * FROM chemical_stats JOIN chemical USING (chem_code))
        UNION ALL SELECT 'sites', id, label, {', '.join(f'round({c}, {n}) AS {c}' for c, n in _STATS.items())} FROM
          (SELECT site_code AS id, site_name AS label, * FROM site_stats JOIN site USING (site_code))
        UNION ALL SELECT 'products', id, label, {', '.join(f'round({c}, {n}) AS {c}' for c, n in _STATS.items())} FROM
          (SELECT prodno AS id, product_name AS label, * FROM product_stats JOIN product USING (prodno))""",
)
def _dimension_tables(t):
    specs = [CHEMICALS, SITES, PRODUCTS]
    codes = {"chemicals": t("chemical"), "sites": t("site"), "products": t("product")}
    tables = dimensions.dimensions(use_fact(t), codes, specs)
    parts = [
        tables[s.name].select(
            F.lit(s.name).alias("name"),
            F.col(s.fact_id).alias("id"),
            F.col(s.out_label).alias("label"),
            *_STATS,
        )
        for s in specs
    ]
    return rounded(parts[0].union(parts[1]).union(parts[2]), _STATS)


@query(
    "active_only",
    """SELECT chem_code, chemname AS chem_name FROM chemical
       WHERE chem_code IN (SELECT chem_code FROM use_fact)""",
)
def _active_only(t):
    return dimensions.code_table(t("chemical"), use_fact(t), CHEMICALS)


# --------------------------------------------------------------------------
# Categories
# --------------------------------------------------------------------------


@query(
    "restricted_flag",
    'SELECT chem_code, ordinal, "Restricted Material" FROM flag_rows',
)
def _restricted_flag(t):
    flags = dimensions.flag_restricted(t("chem_flags"), t("restricted"))
    return flags.select("chem_code", "ordinal", "Restricted Material")


@query(
    "use_type_codes",
    r"""SELECT CASE kind WHEN 'SMALL/herb-o2x' THEN 'Small/Herb-O2X'
          ELSE upper(left(kind, 1)) || lower(substr(kind, 2)) END AS ai_type, "ai_type_ID" FROM ingredient_types""",
)
def _use_type_codes(t):
    return dimensions.use_type_codes(active_flags(t))


@query(
    "health_labels",
    f"SELECT chem_code, {_sql_labels(HEALTH)} AS health, {_sql_labels(CLASSES)} AS major_category FROM flag_rows",
)
def _health_labels(t):
    flags = dimensions.flag_restricted(t("chem_flags"), t("restricted"))
    return flags.select(
        "chem_code",
        label_string(HEALTH).alias("health"),
        label_string(CLASSES).alias("major_category"),
    )


@query(
    "label_count",
    f"""SELECT chem_code, CAST(len(string_split({_sql_labels(HEALTH)}, '|')) AS INTEGER) AS health_count,
        CAST(len(string_split({_sql_labels(CLASSES)}, '|')) AS INTEGER) AS class_count FROM flag_rows""",
)
def _label_count(t):
    flags = dimensions.flag_restricted(t("chem_flags"), t("restricted"))
    return flags.select(
        "chem_code",
        label_count(label_string(HEALTH)).alias("health_count"),
        label_count(label_string(CLASSES)).alias("class_count"),
    )


@query("categories", "SELECT * FROM category_rows")
def _categories(t):
    return categories(t)


def _sql_values(labels: list[Label]) -> str:
    return ", ".join(f"('{x.label}', '{x.id}')" for x in labels)


@query(
    "label_tables",
    f"""SELECT kind, label, id, count(chem_code) AS chemicals FROM (
          SELECT 'health' AS kind, * FROM (VALUES {_sql_values(HEALTH)}) h(label, id)
          UNION ALL SELECT 'class', * FROM (VALUES {_sql_values(CLASSES)}) c(label, id))
        LEFT JOIN (SELECT 'health' AS kind, chem_code, unnest(string_split(health, '|')) AS id FROM category_rows
          UNION ALL SELECT 'class', chem_code, unnest(string_split(major_category, '|')) FROM category_rows)
        USING (kind, id) GROUP BY ALL""",
)
def _label_tables(t):
    rows = categories(t)

    def carried(kind: str, column: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("kind"), F.explode(F.split(column, "[|]")).alias("id")
        )

    def table(kind: str, labels: list[Label]) -> DataFrame:
        return dimensions.label_table(t.spark, labels).withColumn("kind", F.lit(kind))

    counts = (
        carried("health", "health")
        .union(carried("class", "major_category"))
        .groupBy("kind", "id")
        .agg(F.count(F.lit(1)).alias("chemicals"))
    )
    labels = table("health", HEALTH).unionByName(table("class", CLASSES))
    return labels.join(counts, ["kind", "id"], "left").fillna(0, ["chemicals"])


# --------------------------------------------------------------------------
# Keys
# --------------------------------------------------------------------------


@query(
    "dense_use_index",
    """SELECT use_id AS key, CASE WHEN use_id IS NULL THEN n ELSE r END AS use_index FROM
         (SELECT use_id, CAST(dense_rank() OVER (ORDER BY use_id NULLS LAST) - 1 AS BIGINT) AS r FROM use_keyed),
         (SELECT count(DISTINCT use_id) AS n FROM use_keyed)""",
)
def _dense_use_index(t):
    df = use_keyed(t).select("use_id", F.col("use_id").alias("key"))
    return dense_index(df, ["use_id"])


@query(
    "first_row_id",
    """SELECT p_brand, min(p_partkey) AS "p_brand_ID" FROM part GROUP BY p_brand""",
)
def _first_row_id(t):
    return first_row_id(t("part"), "p_brand", "p_partkey")


@query(
    "first_per_key",
    """SELECT p_brand, p_type, p_partkey AS ordinal, p_name FROM part
       QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1""",
)
def _first_per_key(t):
    part = t("part").selectExpr("p_brand", "p_type", "p_partkey AS ordinal", "p_name")
    return first_per_key(part, ["p_brand", "p_type"], "ordinal")


# --------------------------------------------------------------------------
# Crosswalk and unit tables
# --------------------------------------------------------------------------


@query(
    "crosswalk_normalize",
    """SELECT "CO_MTRS", "GEOID", round("AREA_RATIO" * (1 / nullif(sum("AREA_RATIO") OVER (PARTITION BY "CO_MTRS"), 0)), 9) AS "AREA_RATIO"
       FROM (SELECT *, max("AREA_RATIO" > 95e-2) OVER (PARTITION BY "CO_MTRS") AS has FROM section_ratio)
       WHERE "AREA_RATIO" > 95e-2 OR NOT has""",
)
def _crosswalk_normalize(t):
    return rounded(normalize_ratios(t("section_ratio"), "CO_MTRS"), {"AREA_RATIO": 9})


_POUNDS = {"lbs_chm_used": 6, "lbs_prd_used": 6}
_SQL_WEIGHTED = """SELECT use_id, u.usetype, monthyear, chem_code, "GEOID", "AREA_RATIO",
  lbs_chm_used * "AREA_RATIO" AS lbs_chm_used, lbs_prd_used * "AREA_RATIO" AS lbs_prd_used
  FROM use_keyed u LEFT JOIN section_xwalk ON comtrs = "CO_MTRS" WHERE u.usetype = 'AG'"""
NAMED["weighted_use"] = _SQL_WEIGHTED


@query(
    "crosswalk_apportion",
    """SELECT use_id, usetype, monthyear, chem_code, "GEOID", "AREA_RATIO", round(lbs_chm_used, 6) AS lbs_chm_used,
       round(lbs_prd_used, 6) AS lbs_prd_used FROM weighted_use""",
)
def _crosswalk_apportion(t):
    out = weight(use_keyed(t), t("section_xwalk"), TRACT).select(
        "use_id",
        "usetype",
        "monthyear",
        "chem_code",
        "GEOID",
        "AREA_RATIO",
        "lbs_chm_used",
        "lbs_prd_used",
    )
    return rounded(out, _POUNDS)


def _sql_unit(area: str) -> str:
    return f"""
      SELECT adjuvant, round(lbs_chm_used * r, 6) AS lbs_chm_used, aerial_ground, usetype, amount_planted, chem_code,
        county_cd, round(lbs_prd_used * r, 6) AS lbs_prd_used, prodno, site_code, monthyear, major_category, ai_type,
        health, "{area}", CASE WHEN use_id IS NULL OR "{area}" IS NULL THEN (SELECT count(*) FROM pairs) ELSE n END AS use_index
      FROM joined LEFT JOIN pairs USING (use_id, "{area}")"""


def _sql_unit_query(area: str) -> str:
    joined = (
        f"""SELECT u.*, x."{area}", x."AREA_RATIO" AS r FROM enriched_use u"""
        ' LEFT JOIN section_xwalk x ON u.comtrs = x."CO_MTRS" WHERE u.usetype = \'AG\''
    )
    pairs = (
        f"""SELECT use_id, "{area}", row_number() OVER (ORDER BY use_id, "{area}") - 1 AS n FROM"""
        f""" (SELECT DISTINCT use_id, "{area}" FROM ({joined}) WHERE use_id IS NOT NULL AND "{area}" IS NOT NULL)"""
    )
    body = _sql_unit(area)
    return body.replace("FROM joined", f"FROM ({joined})").replace(
        "LEFT JOIN pairs", f"LEFT JOIN ({pairs})"
    ).replace("FROM pairs", f"FROM ({pairs})")


@query("tract_fact", _sql_unit_query("GEOID"))
def _tract_fact(t):
    return rounded(apportion(enriched(t), t("section_xwalk"), TRACT), _POUNDS)


@query("school_fact", _sql_unit_query("FIPS"))
def _school_fact(t):
    return rounded(apportion(enriched(t), t("section_xwalk"), SCHOOL), _POUNDS)


@query("zip_fact", _sql_unit_query("ZCTA5CE20"))
def _zip_fact(t):
    return rounded(apportion(enriched(t), t("section_xwalk"), ZIP), _POUNDS)


@query(
    "dense_area_index",
    """SELECT key, area, CASE WHEN key IS NULL OR area IS NULL THEN (SELECT count(*) FROM
         (SELECT DISTINCT use_id, "GEOID" FROM weighted_use WHERE use_id IS NOT NULL AND "GEOID" IS NOT NULL)) ELSE r END AS use_index
       FROM (SELECT use_id AS key, "GEOID" AS area, CAST(dense_rank() OVER (
         ORDER BY CASE WHEN use_id IS NULL OR "GEOID" IS NULL THEN 1 ELSE 0 END, use_id, "GEOID") - 1 AS BIGINT) AS r FROM weighted_use)""",
)
def _dense_area_index(t):
    rows = weight(use_keyed(t), t("section_xwalk"), TRACT).select(
        "use_id", "GEOID", F.col("use_id").alias("key"), F.col("GEOID").alias("area")
    )
    return dense_index(rows, ["use_id", "GEOID"])


NAMED["indexed_use"] = """SELECT *, CASE WHEN use_id IS NULL THEN (SELECT count(DISTINCT use_id) FROM enriched_use)
  ELSE dense_rank() OVER (ORDER BY use_id NULLS LAST) - 1 END AS use_index FROM enriched_use"""

_FILLED = [
    "adjuvant",
    "aerial_ground",
    "usetype",
    "chem_code",
    "county_cd",
    "prodno",
    "site_code",
    "monthyear",
    "major_category",
    "ai_type",
    "health",
]
_SQL_FILLED = (
    "lbs_chm_used, lbs_prd_used, amount_planted, prodchem_pct, CAST(use_index AS BIGINT) AS use_index, "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in _FILLED)
)


@query(
    "county_fact",
    f"""SELECT {_SQL_FILLED}, x."FIPS" FROM indexed_use LEFT JOIN county_xwalk x ON county_cd = "DPR_ID" """,
)
def _county_fact(t):
    return units.county_fact(enriched(t), t("county_xwalk"))


@query(
    "township_fact",
    f"""SELECT {_SQL_FILLED}, coalesce("MeridianTownshipRange", '') AS "MeridianTownshipRange" FROM indexed_use""",
)
def _township_fact(t):
    return units.unit_fact(enriched(t), TOWNSHIP)


@query(
    "section_fact",
    f"""SELECT {_SQL_FILLED}, coalesce("MeridianTownshipRange", '') AS "MeridianTownshipRange",
        coalesce(comtrs, '') AS comtrs FROM indexed_use""",
)
def _section_fact(t):
    return units.unit_fact(enriched(t), SECTION)


@query("fact_with_categories", "SELECT * FROM enriched_use")
def _fact_with_categories(t):
    return enriched(t)


@query(
    "fact_with_demography",
    """SELECT use_id, w."GEOID", round(lbs_chm_used, 6) AS lbs_chm_used, d.* EXCLUDE ("FIPS")
       FROM weighted_use w LEFT JOIN guarded_tracts d ON w."GEOID" = d."FIPS" """,
)
def _fact_with_demography(t):
    rows = weight(use_keyed(t), t("section_xwalk"), TRACT).select(
        "use_id", "GEOID", "lbs_chm_used"
    )
    return rounded(with_demography(t, rows), {"lbs_chm_used": 6})


@query(
    "product_total",
    """SELECT round(sum(lbs_prd_used), 2) AS lbs_prd_used FROM (SELECT DISTINCT use_id, lbs_prd_used FROM use_keyed)""",
)
def _product_total(t):
    total = distinct_pair_sum(use_keyed(t), "use_id", "lbs_prd_used")
    return rounded(total, {"lbs_prd_used": 2})


def _sql_totals(source: str, key: str) -> str:
    return f"""SELECT
      (SELECT coalesce(sum(lbs_chm_used), 0) FROM {source}) AS chm,
      (SELECT coalesce(sum(lbs_prd_used), 0) FROM (SELECT DISTINCT {key}, lbs_prd_used FROM {source})) AS prd,
      (SELECT coalesce(sum(lbs_chm_used), 0) FROM {source} WHERE usetype = 'AG') AS chm_ag,
      (SELECT coalesce(sum(lbs_prd_used), 0) FROM (SELECT DISTINCT {key}, lbs_prd_used FROM {source} WHERE usetype = 'AG')) AS prd_ag"""


NAMED["tract_pairs"] = (
    "SELECT *, CASE WHEN use_id IS NULL OR \"GEOID\" IS NULL THEN '' ELSE use_id || \"GEOID\" END AS use_area FROM weighted_use"
)
NAMED["base_totals"] = _sql_totals("use_keyed", "use_id")
NAMED["tract_totals"] = _sql_totals("tract_pairs", "use_area")


def _sql_compare(title: str, source: str, measures: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{title}' AS title, '{m}' AS measure, b.{m} AS b, d.{m} AS d FROM base_totals b, {source} d"
        for m in measures
    )


@query(
    "reconcile",
    f"""SELECT title, measure, round(b, 4) AS base, round(d, 4) AS derived, round(b - d, 4) AS diff,
          round_even((b - d) / nullif(b, 0), 4) * 100e0 AS pct FROM (
        {_sql_compare("county", "base_totals", ["chm", "prd", "chm_ag", "prd_ag"])}
        UNION ALL {_sql_compare("tract", "tract_totals", ["chm_ag", "prd_ag"])})""",
)
def _reconcile(t):
    base = enriched(t)
    rows = base.select(*units.RECONCILED)
    out = units.reconcile(
        base,
        {
            "county": units.county_fact(rows, t("county_xwalk")),
            "tract": apportion(rows, t("section_xwalk"), TRACT),
        },
        ag_only=frozenset({"tract"}),
    )
    return rounded(out, {"base": 4, "derived": 4, "diff": 4})


def _sql_area_pairs(area: str) -> str:
    return f"""SELECT u.usetype, CASE WHEN use_id IS NULL OR "{area}" IS NULL THEN '' ELSE use_id || "{area}" END AS use_area,
      lbs_chm_used * "AREA_RATIO" AS lbs_chm_used, lbs_prd_used * "AREA_RATIO" AS lbs_prd_used
      FROM use_keyed u LEFT JOIN section_xwalk ON comtrs = "CO_MTRS" WHERE u.usetype = 'AG'"""


NAMED["school_pairs"] = _sql_area_pairs(SCHOOL.area_id)
NAMED["zip_pairs"] = _sql_area_pairs(ZIP.area_id)
NAMED["school_totals"] = _sql_totals("school_pairs", "use_area")
NAMED["zip_totals"] = _sql_totals("zip_pairs", "use_area")
NAMED["county_rows"] = (
    'SELECT i.*, x."FIPS" FROM indexed_use i LEFT JOIN county_xwalk x ON county_cd = "DPR_ID"'
)
NAMED["county_totals"] = _sql_totals("county_rows", "use_index")
NAMED["unit_totals"] = _sql_totals("indexed_use", "use_index")

_EVERY = ["chm", "prd", "chm_ag", "prd_ag"]
_SQL_LEVELS = " UNION ALL ".join(
    _sql_compare(title, source, _EVERY[2:] if title in units.AG_ONLY else _EVERY)
    for title, source in [
        ("tract", "tract_totals"),
        ("school", "school_totals"),
        ("zip", "zip_totals"),
        ("county", "county_totals"),
        ("township", "unit_totals"),
        ("section", "unit_totals"),
    ]
)


@query(
    "reconcile_every_level",
    f"""SELECT title, measure, round(b, 4) AS base, round(d, 4) AS derived, round(b - d, 4) AS diff,
          round_even((b - d) / nullif(b, 0), 4) * 100e0 AS pct FROM ({_SQL_LEVELS})""",
)
def _reconcile_every_level(t):
    crosswalks = dict.fromkeys(["tract", "school", "zip"], t("section_xwalk"))
    base = enriched(t)
    levels = units.unit_levels(base.select(*units.RECONCILED), crosswalks, t("county_xwalk"))
    out = units.reconcile(base, levels, units.AG_ONLY)
    return rounded(out, {"base": 4, "derived": 4, "diff": 4})


@query(
    "monthly_use_by_tract",
    """SELECT monthyear, "GEOID", round(sum(lbs_chm_used), 4) AS lbs_chm_used, round(sum(lbs_prd_used), 4) AS lbs_prd_used
       FROM weighted_use WHERE "GEOID" IS NOT NULL GROUP BY ALL""",
)
def _monthly_use_by_tract(t):
    weighted = weight(use_keyed(t), t("section_xwalk"), TRACT)
    sums = (
        weighted.where(F.col("GEOID").isNotNull())
        .groupBy("monthyear", "GEOID")
        .agg(
            F.sum("lbs_chm_used").alias("lbs_chm_used"),
            F.sum("lbs_prd_used").alias("lbs_prd_used"),
        )
    )
    return rounded(sums, {"lbs_chm_used": 4, "lbs_prd_used": 4})

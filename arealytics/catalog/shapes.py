"""Geometry queries over shapes laid out by the keys of the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from arealytics.catalog.areas import _sql_shared, _sql_standard
from arealytics.catalog.registry import NAMED, query, rounded
from arealytics.catalog.views import Inputs, div, section_code, tract_code
from arealytics.functions import projection
from arealytics.functions.projection import project_albers
from arealytics.operators import geometry
from arealytics.operators.contours import trace_rings
from arealytics.operators.crosswalk import build_crosswalk
from arealytics.operators.union import union_edges
from arealytics.plans import crosswalks, demography
from arealytics.plans.clean import section_meridians
from arealytics.sources.files import spread
from arealytics.specs import COUNTS, INCOME

# A shape family: table, id, origin, and rings as (condition, hole, corners).
_W, _H = "333e-3", "2e-1"
_FAMILIES = {
    "section": (
        "supplier",
        section_code("s_suppkey"),
        ("CAST(s_suppkey % 10 AS DOUBLE)", f"CAST({div('s_suppkey', 10)} AS DOUBLE)"),
        [
            ("s_suppkey % 2 = 0", False, [("0e0", "0e0"), ("1e0", "0e0"), ("1e0", "1e0"), ("0e0", "1e0")]),
            ("s_suppkey % 2 = 1", False, [("0e0", "0e0"), ("0e0", "1e0"), ("1e0", "1e0"), ("1e0", "0e0")]),
            ("s_suppkey % 6 = 0", True, [("4e-1", "4e-1"), ("6e-1", "4e-1"), ("6e-1", "6e-1"), ("4e-1", "6e-1")]),
        ],
    ),
    "tract": (
        "customer",
        tract_code("c_custkey"),
        (
            "CAST(c_custkey % 30 AS DOUBLE) * 3333e-4 + 517e-4",
            f"CAST({div('c_custkey', 30)} AS DOUBLE) * 2e-1 + 313e-4",
        ),
        [
            ("c_custkey % 3 = 0", False, [("0e0", "0e0"), (_W, "0e0"), (_W, _H), ("0e0", _H)]),
            ("c_custkey % 3 = 1", False, [("0e0", "0e0"), (_W, "0e0"), (_W, _H), ("17e-2", "71e-3"), ("0e0", _H)]),
            ("c_custkey % 3 = 2", False, [("0e0", "0e0"), (_W, "31e-3"), ("11e-2", _H)]),
            ("c_custkey % 50 = 7", False, [("17e-1", "3e-1"), ("23e-1", "3e-1"), ("23e-1", "9e-1"), ("17e-1", "9e-1")]),
        ],
    ),
    "zone": (
        "customer",
        tract_code("c_custkey"),
        (
            "CAST(c_custkey % 7 AS DOUBLE) * 17e-1 - 3e-1",
            f"CAST({div('c_custkey', 20)} AS DOUBLE) * 4e-1",
        ),
        [
            ("c_custkey > 0", False, [("0e0", "0e0"), ("23e-1", "2e-1"), ("12e-1", "8e-1"), ("19e-1", "29e-1"), ("1e-1", "21e-1")]),
        ],
    ),
}


def shapes(t: Inputs, family: str) -> DataFrame:
    """``id, x, y, rings`` of a family."""
    table, key, (x, y), rings = _FAMILIES[family]
    made = [
        f"CASE WHEN {when} THEN named_struct('hole', {str(hole).lower()}, 'points', array("
        + ", ".join(f"named_struct('x', x + {dx}, 'y', y + {dy})" for dx, dy in corners)
        + ")) END"
        for when, hole, corners in rings
    ]
    return (
        spread(t(table))
        .selectExpr("*", f"{key} AS id", f"{x} AS x", f"{y} AS y")
        .selectExpr(
            "id", f"filter(array({', '.join(made)}), r -> r IS NOT NULL) AS rings"
        )
        .where(F.size("rings") > 0)
    )


def edges(t: Inputs, family: str) -> DataFrame:
    return geometry.to_edges(shapes(t, family), "id")


def _name_layer(name: str) -> None:
    """The SQL of sides, edges, sizes and boxes from a layer's vertices."""
    NAMED[f"{name}_side"] = (
        "SELECT id, ring, hole, x AS ax, y AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx,"
        f" coalesce(lead(y) OVER w, first_value(y) OVER w) AS by_ FROM {name}_vertex"
        " WINDOW w AS (PARTITION BY id, ring ORDER BY seq)"
    )
    NAMED[f"{name}_edge"] = (
        "SELECT id, least(ax, bx) AS x0, CASE WHEN ax <= bx THEN ay ELSE by_ END AS y0, greatest(ax, bx) AS x1,"
        " CASE WHEN ax <= bx THEN by_ ELSE ay END AS y1, sign(ax - bx) * turn AS sign FROM ("
        " SELECT *, sign(sum(ax * by_ - bx * ay) OVER (PARTITION BY id, ring)) * CASE WHEN hole THEN -1 ELSE 1 END AS turn"
        f" FROM {name}_side)"
    )
    NAMED[f"{name}_size"] = (
        f"SELECT id, sum(sign * (x1 - x0) * (y0 + y1) / 2e0) AS area FROM {name}_edge GROUP BY id"
    )
    NAMED[f"{name}_box"] = (
        "SELECT id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax"
        f" FROM {name}_vertex GROUP BY id"
    )


for _name, (_table, _key, (_x, _y), _rings) in _FAMILIES.items():
    NAMED[f"{_name}_vertex"] = " UNION ALL ".join(
        f"SELECT {_key} AS id, {ring} AS ring, {str(hole).lower()} AS hole, {i} AS seq,"
        f" {_x} + {dx} AS x, {_y} + {dy} AS y FROM {_table} WHERE {when}"
        for ring, (when, hole, corners) in enumerate(_rings)
        for i, (dx, dy) in enumerate(corners)
    )
    _name_layer(_name)


def _sql_overlap(a: str, b: str) -> str:
    """Every pair of boxes that meet, every pair of their edges; what is below a
    billionth of the smaller shape is rounding."""
    return f"""
      SELECT o.a, o.b, o.area FROM (SELECT a, b, sum(s * (w * (a0 + a1 + b0 + b1) / 4e0 - (CASE WHEN (a0 - b0) * (a1 - b1) >= 0
          THEN w * abs(a0 - b0 + a1 - b1) / 2e0
          ELSE w * ((a0 - b0) * (a0 - b0) + (a1 - b1) * (a1 - b1)) / (2e0 * (abs(a0 - b0) + abs(a1 - b1))) END) / 2e0)) AS area
      FROM (SELECT a, b, s, hi - lo AS w,
              ay0 + (ay1 - ay0) * (lo - ax0) / (ax1 - ax0) AS a0, ay0 + (ay1 - ay0) * (hi - ax0) / (ax1 - ax0) AS a1,
              by0 + (by1 - by0) * (lo - bx0) / (bx1 - bx0) AS b0, by0 + (by1 - by0) * (hi - bx0) / (bx1 - bx0) AS b1
            FROM (SELECT p.id AS a, q.id AS b, e.sign * f.sign AS s, e.x0 AS ax0, e.y0 AS ay0, e.x1 AS ax1, e.y1 AS ay1,
                    f.x0 AS bx0, f.y0 AS by0, f.x1 AS bx1, f.y1 AS by1, greatest(e.x0, f.x0) AS lo, least(e.x1, f.x1) AS hi
                  FROM {a}_box p JOIN {b}_box q ON p.xmin <= q.xmax AND q.xmin <= p.xmax AND p.ymin <= q.ymax AND q.ymin <= p.ymax
                  JOIN {a}_edge e ON e.id = p.id JOIN {b}_edge f ON f.id = q.id
                  WHERE e.x0 < e.x1 AND f.x0 < f.x1) WHERE lo < hi)
      GROUP BY a, b) o JOIN {a}_size p ON p.id = o.a JOIN {b}_size q ON q.id = o.b
      WHERE o.area > least(p.area, q.area) * 1e-9"""


NAMED["section_tract"] = _sql_overlap("section", "tract")
NAMED["zone_section"] = _sql_overlap("zone", "section")
NAMED["tract_section"] = _sql_overlap("tract", "section")


@query("polygon_area", "SELECT id, round(area, 9) AS area FROM tract_size")
def _polygon_area(t):
    return rounded(geometry.layer_area(edges(t, "tract")), {"area": 9})


@query(
    "shape_row_figures",
    """SELECT id, round(area, 9) AS area, round(cx / (6e0 * area), 9) AS x, round(cy / (6e0 * area), 9) AS y FROM (
         SELECT id, sum(k) / 2e0 AS area, sum((ax + bx) * k) AS cx, sum((ay + by_) * k) AS cy FROM (
           SELECT *, (ax * by_ - bx * ay) * sign(sum(ax * by_ - bx * ay) OVER (PARTITION BY id, ring))
             * CASE WHEN hole THEN -1 ELSE 1 END AS k FROM section_side) GROUP BY id)""",
)
def _shape_row_figures(t):
    centre = geometry.ring_centroid(F.col("rings"))
    out = shapes(t, "section").select(
        "id",
        geometry.ring_area(F.col("rings")).alias("area"),
        centre["x"].alias("x"),
        centre["y"].alias("y"),
    )
    return rounded(out, {"area": 9, "x": 9, "y": 9})


@query(
    "polygon_centroid",
    """SELECT id, round(cx / (6e0 * area), 7) AS x, round(cy / (6e0 * area), 7) AS y FROM (
         SELECT id, sum(k) / 2e0 AS area, sum((ax + bx) * k) AS cx, sum((ay + by_) * k) AS cy FROM (
           SELECT *, (ax * by_ - bx * ay) * sign(sum(ax * by_ - bx * ay) OVER (PARTITION BY id, ring)) AS k
           FROM tract_side) GROUP BY id)""",
)
def _polygon_centroid(t):
    centre = geometry.ring_centroid(F.col("rings"))
    out = shapes(t, "tract").select("id", centre["x"].alias("x"), centre["y"].alias("y"))
    return rounded(out, {"x": 7, "y": 7})


@query(
    "interior_point",
    """SELECT id, round(x, 7) AS x, round(y, 7) AS y FROM (
         SELECT *, row_number() OVER (PARTITION BY id ORDER BY w DESC, x) AS rank FROM (
           SELECT id, y, n, lead(x) OVER crossing - x AS w, (x + lead(x) OVER crossing) / 2e0 AS x FROM (
             SELECT id, y, x, row_number() OVER (PARTITION BY id ORDER BY x) AS n FROM (
               SELECT s.id, y, ax + (y - ay) * (bx - ax) / (by_ - ay) AS x FROM tract_side s JOIN (
                 SELECT v.id, (max(CASE WHEN ay <= middle THEN ay END) + min(CASE WHEN ay > middle THEN ay END)) / 2e0 AS y
                 FROM tract_side v JOIN (SELECT id, (min(ay) + max(ay)) / 2e0 AS middle FROM tract_side GROUP BY id) m ON m.id = v.id
                 GROUP BY v.id) l ON l.id = s.id
               WHERE least(ay, by_) <= y AND greatest(ay, by_) > y))
           WINDOW crossing AS (PARTITION BY id ORDER BY n)) WHERE n % 2 = 1) WHERE rank = 1""",
)
def _interior_point(t):
    point = geometry.interior_point(F.col("rings"))
    out = shapes(t, "tract").select("id", point["x"].alias("x"), point["y"].alias("y"))
    return rounded(out, {"x": 7, "y": 7})


_BLOCK = (
    f"CAST(floor((s_suppkey % 10) / 2) AS BIGINT) + 5 * {div(div('s_suppkey', 10), 2)}"
)
_ZONE_NAME = "CASE block % 4 WHEN 0 THEN 'MDM' WHEN 1 THEN 'SBM' WHEN 2 THEN 'HBM' END"


def townships(t: Inputs) -> DataFrame:
    """Two-by-two blocks of sections, ``id, Meridian, rings``."""
    corners = [(0, 0), (2, 0), (2, 2), (0, 2)]
    points = ", ".join(
        f"named_struct('x', x + {dx}, 'y', y + {dy})" for dx, dy in corners
    )
    return (
        t("supplier")
        .selectExpr(f"{_BLOCK} AS block")
        .distinct()
        .selectExpr(
            "CAST(block AS STRING) AS id",
            f"{_ZONE_NAME} AS Meridian",
            "CAST(block % 5 * 2 AS DOUBLE) AS x",
            f"CAST({div('block', 5)} * 2 AS DOUBLE) AS y",
        )
        .selectExpr(
            "id",
            "Meridian",
            f"array(named_struct('hole', false, 'points', array({points}))) AS rings",
        )
    )


@query(
    "dissolve_area",
    f"""SELECT id, count(*) * 4e0 AS area FROM (SELECT {_ZONE_NAME} AS id FROM
          (SELECT DISTINCT {_BLOCK} AS block FROM supplier)) WHERE id IS NOT NULL GROUP BY id""",
)
def _dissolve_area(t):
    parts = townships(t)
    merged = geometry.dissolve_edges(
        geometry.to_edges(parts, "id"),
        parts.select(F.col("id").alias("_part"), "Meridian"),
        "_part",
        "Meridian",
    )
    return rounded(geometry.layer_area(merged), {"area": 6})


# Unit squares on a grid of halves: many of one block overlap.
_HALF_X, _HALF_Y = "(s_suppkey * 7 % 41)", "(s_suppkey * 3 % 37)"
_BLOCK_NAME = "CAST(s_suppkey % 5 AS VARCHAR)"

NAMED["block_cell"] = " UNION ".join(
    f"SELECT {_BLOCK_NAME} AS id, {_HALF_X} + {dx} AS cx, {_HALF_Y} + {dy} AS cy FROM supplier"
    for dx in (0, 1)
    for dy in (0, 1)
)


def blocks(t: Inputs) -> DataFrame:
    """The squares of each block as one shape, as an edge table."""
    x, y = f"CAST({_HALF_X} AS DOUBLE) / 2", f"CAST({_HALF_Y} AS DOUBLE) / 2"
    corners = ", ".join(
        f"named_struct('x', {x} + {dx}, 'y', {y} + {dy})" for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))
    )
    squares = t("supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id",
        f"{_BLOCK_NAME.replace('VARCHAR', 'STRING')} AS block",
        f"array(named_struct('hole', false, 'points', array({corners}))) AS rings",
    )
    keys = squares.select(F.col("id").alias("_part"), "block")
    return union_edges(geometry.to_edges(squares, "id"), keys, "_part", "block")


@query(
    "union_area",
    "SELECT id, round(count(*) * 25e-2, 6) AS area FROM block_cell GROUP BY id",
)
def _union_area(t):
    return rounded(geometry.layer_area(blocks(t)), {"area": 6})


@query(
    "dissolved_rings",
    """SELECT id, round(count(*) * 25e-2, 6) AS area, round(sum(open) * 5e-1, 6) AS outline FROM (
         SELECT c.id, c.cx, c.cy, 4 - count(d.id) AS open FROM block_cell c LEFT JOIN block_cell d
           ON d.id = c.id AND abs(d.cx - c.cx) + abs(d.cy - c.cy) = 1 GROUP BY c.id, c.cx, c.cy)
       GROUP BY id""",
)
def _dissolved_rings(t):
    length = F.aggregate(
        F.flatten(F.transform("rings", lambda r: geometry._sides(r["points"]))),
        F.lit(0.0),
        lambda sum_, s: sum_ + F.abs(s["bx"] - s["ax"]) + F.abs(s["by"] - s["ay"]),
    )
    out = trace_rings(blocks(t)).select(
        "id", geometry.ring_area(F.col("rings")).alias("area"), length.alias("outline")
    )
    return rounded(out, {"area": 6, "outline": 6})


@query(
    "dissolve_attributes",
    """SELECT p_brand, arg_min(p_name, p_partkey) AS p_name, arg_min(p_size, p_partkey) AS p_size
       FROM part GROUP BY p_brand""",
)
def _dissolve_attributes(t):
    part = t("part").select("p_brand", "p_partkey", "p_name", "p_size")
    return geometry.dissolve_attributes(part, "p_brand", "p_partkey")


@query(
    "section_meridians",
    f"""SELECT * FROM (SELECT {section_code('s_suppkey')} AS "CO_MTRS", {_ZONE_NAME} AS "Meridian"
          FROM (SELECT s_suppkey, {_BLOCK} AS block FROM supplier)) WHERE "Meridian" IS NOT NULL""",
)
def _section_meridians(t):
    centre = geometry.ring_centroid(F.col("rings"))
    points = shapes(t, "section").select(
        F.col("id").alias("point"), centre["x"].alias("x"), centre["y"].alias("y")
    )
    parts = townships(t)
    return section_meridians(
        points, geometry.to_edges(parts, "id"), parts.select("id", "Meridian")
    )


@query(
    "points_within",
    f"""SELECT point, {section_code('s_suppkey')} AS id FROM orders_point JOIN
          (SELECT s_suppkey, CAST(s_suppkey % 10 AS DOUBLE) AS sx, CAST({div('s_suppkey', 10)} AS DOUBLE) AS sy FROM supplier)
          ON x > sx AND x < sx + 1e0 AND y > sy AND y < sy + 1e0
        WHERE NOT (s_suppkey % 6 = 0 AND x >= sx + 4e-1 AND x <= sx + 6e-1 AND y >= sy + 4e-1 AND y <= sy + 6e-1)""",
)
def _points_within(t):
    return geometry.points_within(t("orders_point"), edges(t, "section"))


NAMED["section_point"] = (
    f"SELECT {section_code('s_suppkey')} AS point, CAST(s_suppkey % 10 AS DOUBLE) + 23e-2 AS x,"
    f" CAST({div('s_suppkey', 10)} AS DOUBLE) + 37e-2 AS y FROM supplier"
)


def _sql_inside(layer: str) -> str:
    return (
        f"SELECT point, e.id FROM section_point p JOIN {layer}_edge e ON e.x0 <= p.x AND p.x < e.x1"
        " AND p.y < e.y0 + (e.y1 - e.y0) * (p.x - e.x0) / (e.x1 - e.x0)"
        " GROUP BY point, e.id HAVING count(*) % 2 = 1"
    )


NAMED["in_tract"] = _sql_inside("tract")
NAMED["in_zone"] = _sql_inside("zone")


@query(
    "locate_layers",
    """SELECT DISTINCT p.point, a.id AS tract, b.id AS zone FROM section_point p
       LEFT JOIN in_tract a ON a.point = p.point LEFT JOIN in_zone b ON b.point = p.point""",
)
def _locate_layers(t):
    points = t("supplier").selectExpr(
        f"{section_code('s_suppkey')} AS point",
        "CAST(s_suppkey % 10 AS DOUBLE) + 23e-2 AS x",
        f"CAST({div('s_suppkey', 10)} AS DOUBLE) + 37e-2 AS y",
    )
    return geometry.locate_layers(
        points, {"tract": edges(t, "tract"), "zone": edges(t, "zone")}
    )


@query(
    "overlay_ratios",
    """SELECT a AS section, b AS tract, round_even(o.area / s.area, 4) AS "AREA_RATIO"
       FROM section_tract o JOIN section_size s ON s.id = a""",
)
def _overlay_ratios(t):
    return geometry.overlay_ratios(
        edges(t, "section"), edges(t, "tract"), "section", "tract"
    )


@query(
    "overlay_area",
    "SELECT a, b, round(area, 7) AS area FROM zone_section",
)
def _overlay_area(t):
    out = geometry.overlap_area(edges(t, "zone"), edges(t, "section"))
    return rounded(out, {"area": 7})


@query(
    "build_crosswalk",
    """SELECT tract, section, round(r * (1 / nullif(sum(r) OVER (PARTITION BY tract), 0)), 7) AS "AREA_RATIO" FROM (
         SELECT *, max(r > 95e-2) OVER (PARTITION BY tract) AS has FROM (
           SELECT a AS tract, b AS section, round_even(o.area / s.area, 4) AS r FROM tract_section o JOIN tract_size s ON s.id = a))
       WHERE r > 95e-2 OR NOT has""",
)
def _build_crosswalk(t):
    out = build_crosswalk(edges(t, "tract"), edges(t, "section"), "tract", "section")
    return rounded(out, {"AREA_RATIO": 7})


def _sql_q(sine: str) -> str:
    e, e2 = f"{projection.ECCENTRICITY!r}", f"{projection.ECCENTRICITY_2!r}"
    return (
        f"(1e0 - CAST({e2} AS DOUBLE)) * ({sine} / (1e0 - CAST({e2} AS DOUBLE) * {sine} * {sine})"
        f" - ln((1e0 - CAST({e} AS DOUBLE) * {sine}) / (1e0 + CAST({e} AS DOUBLE) * {sine})) / (2e0 * CAST({e} AS DOUBLE)))"
    )


_LONLAT = (
    "c_custkey % 1000 / 100e0 - 124e0 AS lon",
    "c_custkey * 7 % 950 / 100e0 + 325e-1 AS lat",
)


def _sql_albers(lon: str, lat: str, extra: str, source: str) -> str:
    """Rows of ``source`` with projected x and y."""
    return f"""SELECT {extra}, r * sin(theta) AS x, CAST({projection.RADIUS_0!r} AS DOUBLE) - 4000000e0 - r * cos(theta) AS y
        FROM (SELECT *, radians(lon + 120e0) * CAST({projection.CONE!r} AS DOUBLE) AS theta,
          6378137e0 * sqrt(CAST({projection.SCALE!r} AS DOUBLE) - CAST({projection.CONE!r} AS DOUBLE) * ({_sql_q("s")}))
            / CAST({projection.CONE!r} AS DOUBLE) AS r
          FROM (SELECT *, sin(radians(lat)) AS s FROM (SELECT *, {lon} AS lon, {lat} AS lat FROM {source})))"""


@query(
    "project_albers",
    f"""SELECT c_custkey, round(r * sin(theta), 3) AS x, round(CAST({projection.RADIUS_0!r} AS DOUBLE) - 4000000e0 - r * cos(theta), 3) AS y
        FROM (SELECT c_custkey, radians(lon + 120e0) * CAST({projection.CONE!r} AS DOUBLE) AS theta,
          6378137e0 * sqrt(CAST({projection.SCALE!r} AS DOUBLE) - CAST({projection.CONE!r} AS DOUBLE) * ({_sql_q("s")}))
            / CAST({projection.CONE!r} AS DOUBLE) AS r
          FROM (SELECT c_custkey, lon, sin(radians(lat)) AS s FROM (SELECT c_custkey, {", ".join(_LONLAT)} FROM customer)))""",
)
def _project_albers(t):
    points = t("customer").selectExpr("c_custkey", *_LONLAT)
    at = project_albers(F.col("lon"), F.col("lat"))
    out = points.select("c_custkey", at["x"].alias("x"), at["y"].alias("y"))
    return rounded(out, {"x": 3, "y": 3})


def _sql_grid(lon: str, lat: str) -> tuple[str, str]:
    e = f"CAST({projection.ECCENTRICITY!r} AS DOUBLE)"
    t = f"tan(pi() / 4e0 - radians({lat}) / 2e0) / power((1e0 - {e} * sin(radians({lat}))) / (1e0 + {e} * sin(radians({lat}))), {e} / 2e0)"
    radius = f"CAST({projection.GRID_SCALE!r} AS DOUBLE) * power({t}, CAST({projection.GRID_CONE!r} AS DOUBLE))"
    angle = f"radians({lon} + 1205e-1) * CAST({projection.GRID_CONE!r} AS DOUBLE)"
    foot = "(1200e0 / 3937e0)"
    return (
        f"(2e6 + {radius} * sin({angle})) / {foot}",
        f"(5e5 + CAST({projection.GRID_RADIUS_0!r} AS DOUBLE) - {radius} * cos({angle})) / {foot}",
    )


@query(
    "project_grid",
    """SELECT c_custkey, round({}, 2) AS x, round({}, 2) AS y, round(lon, 8) AS lon, round(lat, 8) AS lat
       FROM (SELECT c_custkey, {} FROM customer)""".format(*_sql_grid("lon", "lat"), ", ".join(_LONLAT)),
)
def _project_grid(t):
    """To the local grid, and back to what it began with."""
    points = t("customer").selectExpr("c_custkey", *_LONLAT)
    at = points.withColumn("_p", projection.project_grid(F.col("lon"), F.col("lat")))
    back = projection.from_grid(F.col("_p.x"), F.col("_p.y"))
    out = at.select("c_custkey", "_p.x", "_p.y", back["x"].alias("lon"), back["y"].alias("lat"))
    return rounded(out, {"x": 2, "y": 2, "lon": 8, "lat": 8})


# The plane layers laid out on the globe, a hundredth of a degree per unit.
_LON, _LAT = "x * 1e-2 - 1195e-1", "y * 1e-2 + 365e-1"
_TOWNSHIP_NAME = f"concat({_ZONE_NAME.replace('END', 'ELSE chr(32) END')}, ' ', CASE WHEN block % 4 = 3 THEN '' ELSE concat('T', CAST({div('block', 2)} AS STRING)) END)"

NAMED["block_vertex"] = " UNION ALL ".join(
    f"SELECT CAST(block AS VARCHAR) AS id, block * 4 AS ring, false AS hole, {i} AS seq,"
    f" CAST(block % 5 * 2 + {dx} AS DOUBLE) AS x, CAST({div('block', 5)} * 2 + {dy} AS DOUBLE) AS y, block"
    f" FROM (SELECT DISTINCT {_BLOCK} AS block FROM supplier)"
    for i, (dx, dy) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2)])
)
NAMED["township_vertex"] = (
    f"SELECT trim({_TOWNSHIP_NAME}) AS id, ring, hole, seq, x, y FROM block_vertex WHERE trim({_TOWNSHIP_NAME}) <> ''"
)
for _name in ("section", "tract", "zone", "block", "township"):
    NAMED[f"geo_{_name}_vertex"] = _sql_albers(_LON, _LAT, "id, ring, hole, seq", f"{_name}_vertex")
    _name_layer(f"geo_{_name}")


def _on_globe(df: DataFrame) -> DataFrame:
    point = lambda p: F.struct(
        (p["x"] * 0.01 - 119.5).alias("x"), (p["y"] * 0.01 + 36.5).alias("y")
    )
    return df.withColumn("rings", F.transform("rings", lambda r: F.struct(
        r["hole"].alias("hole"), F.transform(r["points"], point).alias("points"))))


def _sql_crosswalk(name: str, source: str, target: str) -> str:
    NAMED[f"geo_{name}"] = _sql_overlap(f"geo_{source}", f"geo_{target}")
    return f"""SELECT '{name}' AS crosswalk, source, target,
         round(r * (1 / nullif(sum(r) OVER (PARTITION BY source), 0)), 7) AS "AREA_RATIO" FROM (
         SELECT *, max(r > 95e-2) OVER (PARTITION BY source) AS has FROM (
           SELECT a AS source, b AS target, round_even(o.area / s.area, 4) AS r
           FROM geo_{name} o JOIN geo_{source}_size s ON s.id = a))
       WHERE r > 95e-2 OR NOT has"""


_CROSSWALKS = {
    "section_zip": ("section", "zone"),
    "section_tract": ("section", "tract"),
    "section_school": ("section", "block"),
    "tract_section": ("tract", "section"),
    "tract_township": ("tract", "township"),
}


@query(
    "crosswalk_job",
    " UNION ALL ".join(_sql_crosswalk(n, s, x) for n, (s, x) in _CROSSWALKS.items()),
)
def _crosswalk_job(t):
    parts = townships(t).withColumn("block", F.col("id").cast("long"))
    named = parts.select(
        F.when(F.col("block") % 4 == 3, " ").otherwise(F.col("Meridian")).alias("Meridian"),
        F.when(F.col("block") % 4 == 3, "")
        .otherwise(F.concat(F.lit("T"), F.floor(F.col("block") / 2).cast("string")))
        .alias("TownshipRange"),
        "rings",
    )
    found = crosswalks.crosswalk_job(
        _on_globe(shapes(t, "section")).withColumnRenamed("id", "CO_MTRS"),
        _on_globe(shapes(t, "tract")).withColumnRenamed("id", "GEOID"),
        _on_globe(shapes(t, "zone")).withColumnRenamed("id", "ZCTA5CE20"),
        _on_globe(parts.select(F.col("id").alias("FIPS"), "rings")),
        _on_globe(named),
    )
    rows = [
        df.select(F.lit(name).alias("crosswalk"), F.col(df.columns[0]).alias("source"),
                  F.col(df.columns[1]).alias("target"), "AREA_RATIO")
        for name, df in found.items()
    ]
    return rounded(reduce(DataFrame.unionByName, rows), {"AREA_RATIO": 7})


NAMED["every_section_sums"] = _sql_shared(COUNTS) + ' GROUP BY "CO_MTRS"'
NAMED["every_section_income"] = (
    f'SELECT * EXCLUDE ("{INCOME}"), "{INCOME}" / nullif(w, 0) AS "{INCOME}" FROM every_section_sums'
)
NAMED["every_section_figures"] = _sql_standard("every_section_income", "comtrs")


@query(
    "polygon_area_demography",
    """SELECT f.*, round(g.area, 2) AS "ALAND" FROM every_section_figures f JOIN geo_section_size g ON g.id = f.comtrs""",
)
def _polygon_area_demography(t):
    """Demography of sections with the projected area of their polygons."""
    areas = crosswalks.section_areas(
        _on_globe(shapes(t, "section")).withColumnRenamed("id", "CO_MTRS")
    )
    crosswalk = t("section_xwalk").withColumnRenamed("CO_MTRS", "comtrs")
    out = demography.area_demography(areas, crosswalk, t("tract_survey"), "comtrs")
    return rounded(out, {"ALAND": 2})

"""True union of parts that may overlap, touch or repeat, as an edge table.

Edges of one key are cut where they cross, touch or run along each other; cut
edges that coincide become one.  A cut edge belongs to the outline when exactly
one of its sides is covered: no other part contains its middle, and the parts
that own it lie on one side of it.  For upright edges both sides are looked at.

Everything is a join of edges with near edges (cells, strips) and an aggregate
per cut edge; no row or task holds a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.operators.geometry import (
    _at_own,
    _boxes,
    _cell,
    _leveled,
    _meet,
    _once_each,
    _slab_level,
    _width_levels,
)
from arealytics.operators.joins import fits_stored, lookup_join
from arealytics.session import pin

TOUCH = 1e-10  # distance, as a share of two edges' lengths, that counts as none

_ENDS = ("x0", "y0", "x1", "y1")


def _named(edges: DataFrame, keys: DataFrame, part: str, key: str) -> DataFrame:
    """Edges with their key and an ``id`` for each part of each key."""
    once = _once_each(edges, keys, part, key).select(part, key)
    joined = lookup_join(edges.withColumnRenamed("id", part), once, [part], "inner")
    low = F.least("y0", "y1")
    upright = F.col("x0") == F.col("x1")
    return joined.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.concat_ws("\x01", F.col(key).cast("string"), F.col(part).cast("string")).alias("id"),
        "x0",
        F.when(upright, low).otherwise(F.col("y0")).alias("y0"),
        "x1",
        F.when(upright, F.greatest("y0", "y1")).otherwise(F.col("y1")).alias("y1"),
        "sign",
        F.monotonically_increasing_id().alias("edge"),
    )


def _neighbours(named: DataFrame) -> DataFrame:
    """(id, other): parts of one key whose boxes meet, both ways round."""
    boxes = pin(_boxes(named))
    key_of = named.groupBy("id").agg(F.first("_key").alias("_key"))
    near = _meet(boxes, boxes, strict=False).where("f <> c").select("f", "c")
    first = key_of.withColumnsRenamed({"id": "f", "_key": "_of_f"})
    second = key_of.withColumnsRenamed({"id": "c", "_key": "_of_c"})
    same = near.join(first, "f").join(second, "c").where("_of_f = _of_c")
    return (
        same.select(F.col("f").alias("id"), F.col("c").alias("other"))
        .unionByName(same.select(F.col("c").alias("id"), F.col("f").alias("other")))
        .distinct()
    )


# --------------------------------------------------------------------------
# Cutting
# --------------------------------------------------------------------------


def _cuts(named: DataFrame) -> DataFrame:
    """(edge, x, y): where edges of different parts of a key meet."""
    boxes = pin(
        _leveled(
            named.select(
                F.col("edge").alias("id"),
                F.col("x0").alias("xmin"),
                F.col("x1").alias("xmax"),
                F.least("y0", "y1").alias("ymin"),
                F.greatest("y0", "y1").alias("ymax"),
            )
        )
    )
    near = _meet(boxes, boxes, strict=False).where("f <> c").select(
        F.least("f", "c").alias("a"), F.greatest("f", "c").alias("b")
    ).distinct()

    def side(name: str) -> DataFrame:
        columns = {"edge": name} | {c: f"{name}_{c}" for c in ("_key", "id", *_ENDS)}
        return named.drop("sign").withColumnsRenamed(columns)

    met = near.join(side("a"), "a").join(side("b"), "b").where(
        (F.col("a__key") == F.col("b__key")) & (F.col("a_id") != F.col("b_id"))
    )
    ax0, ay0, ax1, ay1 = (F.col(f"a_{c}") for c in _ENDS)
    bx0, by0, bx1, by1 = (F.col(f"b_{c}") for c in _ENDS)
    rax, ray, rbx, rby = ax1 - ax0, ay1 - ay0, bx1 - bx0, by1 - by0
    met = met.select(
        "a", "b", *[F.col(f"{s}_{c}") for s in "ab" for c in _ENDS],
        rax.alias("rax"), ray.alias("ray"), rbx.alias("rbx"), rby.alias("rby"),
        F.sqrt(rax * rax + ray * ray).alias("la"), F.sqrt(rbx * rbx + rby * rby).alias("lb"),
        (rax * (by0 - ay0) - ray * (bx0 - ax0)).alias("d1"),  # b's ends against a
        (rax * (by1 - ay0) - ray * (bx1 - ax0)).alias("d2"),
        (rbx * (ay0 - by0) - rby * (ax0 - bx0)).alias("d3"),  # a's ends against b
        (rbx * (ay1 - by0) - rby * (ax1 - bx0)).alias("d4"),
    )
    la, lb = F.col("la"), F.col("lb")
    slack = F.lit(TOUCH) * (la + lb)

    def on(d: str, length: Column) -> Column:
        return F.abs(F.col(d)) <= slack * length

    def touch(edge: str, d: str, x: Column, y: Column) -> Column:
        """The end (x, y) of the other edge as a cut of ``edge``."""
        length = F.col(f"l{edge}")
        along = (x - F.col(f"{edge}_x0")) * F.col(f"r{edge}x") + (
            y - F.col(f"{edge}_y0")
        ) * F.col(f"r{edge}y")
        inside = (along > slack * length) & (along < length * (length - slack))
        return F.when(on(d, length) & inside, _cut(F.col(edge), x, y))

    crossing = (
        ~(on("d1", la) | on("d2", la) | on("d3", lb) | on("d4", lb))
        & (F.signum("d1") != F.signum("d2"))
        & (F.signum("d3") != F.signum("d4"))
    )
    t = F.try_divide(F.col("d3"), F.col("d3") - F.col("d4"))
    x, y = ax0 + t * F.col("rax"), ay0 + t * F.col("ray")
    found = F.array(
        F.when(crossing, _cut(F.col("a"), x, y)),
        F.when(crossing, _cut(F.col("b"), x, y)),
        touch("a", "d1", bx0, by0),
        touch("a", "d2", bx1, by1),
        touch("b", "d3", ax0, ay0),
        touch("b", "d4", ax1, ay1),
    )
    return met.select(F.inline(F.filter(found, lambda c: c.isNotNull())))


def _cut(edge: Column, x: Column, y: Column) -> Column:
    return F.struct(edge.alias("edge"), x.alias("x"), y.alias("y"))


def _cut_edges(named: DataFrame) -> DataFrame:
    """The edges in pieces, each again with x0 <= x1 and the sign to match."""
    cuts = _cuts(named).groupBy("edge").agg(F.collect_set(F.struct("x", "y")).alias("_cuts"))
    joined = named.join(cuts, "edge", "left")
    x0, y0, x1, y1 = map(F.col, _ENDS)

    def placed(x: Column, y: Column) -> Column:
        along = (x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)
        return F.struct(along.alias("t"), x.alias("x"), y.alias("y"))

    points = F.array_sort(
        F.concat(
            F.array(placed(x0, y0), placed(x1, y1)),
            F.transform(
                F.coalesce("_cuts", F.array().cast("array<struct<x:double,y:double>>")),
                lambda c: placed(c["x"], c["y"]),
            ),
        )
    )
    following = F.slice(F.col("_points"), F.lit(2), F.size("_points"))
    pieces = F.arrays_zip(
        F.slice(F.col("_points"), F.lit(1), F.size("_points") - 1).alias("p"),
        following.alias("q"),
    )
    cut = joined.withColumn("_points", points).select(
        "_key", "id", "sign", F.explode(pieces).alias("_s")
    )
    p, q = F.col("_s.p"), F.col("_s.q")
    forward = (p["x"] < q["x"]) | ((p["x"] == q["x"]) & (p["y"] <= q["y"]))
    return cut.where((p["x"] != q["x"]) | (p["y"] != q["y"])).select(
        "_key",
        "id",
        F.when(forward, p["x"]).otherwise(q["x"]).alias("x0"),
        F.when(forward, p["y"]).otherwise(q["y"]).alias("y0"),
        F.when(forward, q["x"]).otherwise(p["x"]).alias("x1"),
        F.when(forward, q["y"]).otherwise(p["y"]).alias("y1"),
        F.when(p["x"] == q["x"], 0)
        .when(p["x"] < q["x"], F.col("sign"))
        .otherwise(-F.col("sign"))
        .cast("int")
        .alias("sign"),
    )


# --------------------------------------------------------------------------
# Which pieces are outline
# --------------------------------------------------------------------------


def _covering(pieces: DataFrame, named: DataFrame, pairs: DataFrame) -> DataFrame:
    """(piece, right, left): whether any part covers the middle of a piece just
    right and just left of it.  Owners count for upright pieces only."""
    upright = F.col("x0") == F.col("x1")
    middles = pieces.select(
        "piece",
        "owners",
        upright.alias("upright"),
        ((F.col("x0") + F.col("x1")) / 2.0).alias("x"),
        ((F.col("y0") + F.col("y1")) / 2.0).alias("y"),
        F.explode("owners").alias("id"),
    )
    others = middles.join(pairs, "id").where(
        F.col("upright") | ~F.array_contains("owners", F.col("other"))
    )
    asked = (
        others.select("piece", "x", "y", F.col("other").alias("id"))
        .unionByName(middles.where("upright").select("piece", "x", "y", "id"))
        .distinct()
    )
    levels = _width_levels(named)[0]
    sloped = named.where("x0 <> x1").select("id", *_ENDS)
    cut = _at_own(sloped.withColumn("level", _slab_level(levels))).drop("level")
    asked = asked.withColumn("lv", F.explode(F.array(*map(F.lit, levels)))).withColumn(
        "slab", _cell(F.col("x"), F.col("lv"))
    )
    met = lookup_join(asked, cut, ["id", "lv", "slab"], "inner", fits_stored(named, 2))
    x, y = F.col("x"), F.col("y")
    x0, y0, x1, y1 = map(F.col, _ENDS)
    below = y < y0 + (y1 - y0) * (x - x0) / (x1 - x0)
    # one row per edge above the middle; a part covers it if their number is odd
    counted = met.where(below & (x >= x0) & (x <= x1)).groupBy("piece", "id").agg(
        F.count(F.when(x < x1, 1)).alias("right"), F.count(F.when(x > x0, 1)).alias("left")
    )
    return counted.groupBy("piece").agg(
        F.max(F.col("right") % 2 == 1).alias("right"), F.max(F.col("left") % 2 == 1).alias("left")
    )


def union_edges(edges: DataFrame, keys: DataFrame, part: str, key: str) -> DataFrame:
    """Merge the parts of each key into the shape that they cover together.

    ``keys`` maps ``part`` (an id of the layer) to ``key``.  Parts may overlap,
    contain and touch each other; one listed again counts once.  Ends of edges
    nearer to another edge than a ten-billionth of their lengths lie on it.
    """
    named = pin(_named(edges, keys, part, key))
    pairs = pin(_neighbours(named))
    alone = named.join(pairs.select("id").distinct(), "id", "left_anti")
    crowd = pin(named.join(pairs.select("id").distinct(), "id", "left_semi"))
    pieces = pin(
        _cut_edges(crowd)
        .groupBy("_key", *_ENDS)
        .agg(
            F.collect_set("id").alias("owners"),
            F.max("sign").alias("plus"),
            F.min("sign").alias("minus"),
        )
        .withColumn("piece", F.monotonically_increasing_id())
    )
    covered = _covering(pieces, crowd, pairs)
    right, left = (F.coalesce(c, F.lit(False)) for c in ("right", "left"))
    upright = F.col("x0") == F.col("x1")
    sign = F.when(upright | right, 0).otherwise(
        F.greatest("plus", F.lit(0)) + F.least("minus", F.lit(0))
    )
    outline = (
        pieces.join(covered, "piece", "left")
        .withColumn("sign", sign.cast("int"))
        .where((F.col("sign") != 0) | (upright & (right != left)))
    )
    columns = [F.col("_key").alias("id"), *_ENDS, "sign"]
    return outline.select(*columns).unionByName(alone.select(*columns))

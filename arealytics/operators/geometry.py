"""Polygon areas, centroids, containment and overlay as DataFrame operations.

A shape is one row with ``rings ARRAY<STRUCT<hole BOOLEAN, points ARRAY<STRUCT<x
DOUBLE, y DOUBLE>>>>``.  A *layer* is the long edge table of a set of shapes:
``(id, x0, y0, x1, y1, sign)`` with ``x0 <= x1``.  The signs are such that the
indicator of a shape is ``sum(sign * [x0 <= x < x1 and y < edge height at x])``,
which makes area, containment and overlap plain sums over edges: they need no
clipping, take holes and several parts, and aggregate partially.

Parts of one shape must not overlap each other; ``operators.union`` makes one
shape of parts that do.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.operators.joins import fits_stored, lookup_join
from arealytics.session import pin

RINGS_TYPE = (
    "array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"
)

# Cells are squares of side 2**level; a shape lies in cells about its own size.
_LOWEST, _HIGHEST = -40, 60
_CELLS = 4  # that a shape touches at its own level, at most


def _zero() -> Column:
    return F.lit(0.0)


def _sides(points: Column) -> Column:
    """Consecutive point pairs of a ring, closed whether or not the last point
    repeats the first."""
    following = F.concat(F.slice(points, F.lit(2), F.size(points)), F.slice(points, 1, 1))
    return F.zip_with(
        points,
        following,
        lambda a, b: F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")
        ),
    )


def _twice_area(sides: Column, x: Column, y: Column) -> Column:
    """Shoelace sum relative to (x, y), positive for counter-clockwise."""
    return F.aggregate(
        sides,
        _zero(),
        lambda acc, s: acc
        + (s["ax"] - x) * (s["by"] - y)
        - (s["bx"] - x) * (s["ay"] - y),
    )


def _origin(points: Column) -> tuple[Column, Column]:
    first = F.element_at(points, 1)
    return first["x"], first["y"]


def rings_from_points(points: Column) -> Column:
    """A ``rings`` column from one outer ring of points."""
    return F.array(
        F.struct(F.lit(False).alias("hole"), points.alias("points"))
    )


def ring_area(rings: Column) -> Column:
    """Area of a shape from its own row: no explode, no shuffle."""
    return F.aggregate(
        rings,
        _zero(),
        lambda acc, r: acc
        + F.when(r["hole"], F.lit(-0.5)).otherwise(F.lit(0.5))
        * F.abs(_twice_area(_sides(r["points"]), *_origin(r["points"]))),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it under a name.  A column used
    inside a lambda is otherwise worked out again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ring_centroid(rings: Column) -> Column:
    """``struct(x, y)``, moments taken relative to the first vertex."""
    x0, y0 = _origin(F.element_at(rings, 1)["points"])

    def moments(acc: Column, ring: Column) -> Column:
        sides = _sides(ring["points"])
        sign = F.signum(_twice_area(sides, *_origin(ring["points"]))) * F.when(
            ring["hole"], F.lit(-1.0)
        ).otherwise(F.lit(1.0))

        def add(m: Column, s: Column, turn: Column) -> Column:
            ax, ay = s["ax"] - x0, s["ay"] - y0
            bx, by = s["bx"] - x0, s["by"] - y0
            cross = (ax * by - bx * ay) * turn
            return F.struct(
                (m["a"] + cross).alias("a"),
                (m["x"] + (ax + bx) * cross).alias("x"),
                (m["y"] + (ay + by) * cross).alias("y"),
            )

        return _let(
            sign, lambda turn: F.aggregate(sides, acc, lambda m, s: add(m, s, turn))
        )

    start = F.struct(_zero().alias("a"), _zero().alias("x"), _zero().alias("y"))
    return _let(
        F.aggregate(rings, start, moments),
        lambda total: F.when(
            total["a"] != 0,
            F.struct(
                (x0 + total["x"] / (total["a"] * 3.0)).alias("x"),
                (y0 + total["y"] / (total["a"] * 3.0)).alias("y"),
            ),
        ),
    )


def _scan_line(heights: Column) -> Column:
    """Halfway between the vertex heights just below and above the middle."""
    middle = (F.array_min(heights) + F.array_max(heights)) / 2.0
    return _let(
        middle,
        lambda m: (
            F.array_max(F.filter(heights, lambda h: h <= m))
            + F.array_min(F.filter(heights, lambda h: h > m))
        )
        / 2.0,
    )


def _widest_stretch(xs: Column) -> Column:
    """Middle of the widest of the stretches (1st, 2nd), (3rd, 4th), ...; the
    leftmost of equally wide ones."""
    stretches = F.transform(
        F.sequence(F.lit(1), F.size(xs) - 1, F.lit(2)),
        lambda i: F.struct(
            (F.element_at(xs, i + 1) - F.element_at(xs, i)).alias("width"),
            (-(F.element_at(xs, i) + F.element_at(xs, i + 1)) / 2.0).alias("back"),
        ),
    )
    return -F.array_max(stretches)["back"]


def interior_point(rings: Column) -> Column:
    """A point inside the shape: middle of the widest inside stretch of the
    horizontal line halfway between the vertex heights around the box centre."""
    sides = F.flatten(F.transform(rings, lambda r: _sides(r["points"])))

    def crossings(all_sides: Column, level: Column) -> Column:
        crossing = F.filter(
            all_sides,
            lambda s: (F.least(s["ay"], s["by"]) <= level)
            & (F.greatest(s["ay"], s["by"]) > level),
        )
        return F.array_sort(
            F.transform(
                crossing,
                lambda s: s["ax"]
                + (level - s["ay"]) * (s["bx"] - s["ax"]) / (s["by"] - s["ay"]),
            )
        )

    def at_level(all_sides: Column, level: Column) -> Column:
        return _let(
            crossings(all_sides, level),
            lambda xs: F.when(
                F.size(xs) >= 2,
                F.struct(_widest_stretch(xs).alias("x"), level.alias("y")),
            ),
        )

    return _let(
        sides,
        lambda all_sides: _let(
            _scan_line(F.transform(all_sides, lambda s: s["ay"])),
            lambda level: at_level(all_sides, level),
        ),
    )


def to_edges(shapes: DataFrame, shape_id: str, rings: str = "rings") -> DataFrame:
    """The edge table of a layer, one pass over the shape rows.

    Upright edges carry no area; they stay with sign 0 because a point may lie
    on one.
    """
    ring = shapes.select(F.col(shape_id).alias("id"), F.explode(rings).alias("_r"))
    sides = ring.select(
        "id",
        F.col("_r")["hole"].alias("_hole"),
        F.col("_r")["points"].alias("_points"),
        _sides(F.col("_r")["points"]).alias("_sides"),
    ).select(
        "id",
        (
            F.signum(_twice_area(F.col("_sides"), *_origin(F.col("_points"))))
            * F.when(F.col("_hole"), F.lit(-1.0)).otherwise(F.lit(1.0))
        ).alias("_turn"),
        F.explode("_sides").alias("_s"),
    )
    s = F.col("_s")
    right = s["ax"] <= s["bx"]
    return (
        sides.where((s["ax"] != s["bx"]) | (s["ay"] != s["by"]))
        .select(
            "id",
            F.when(right, s["ax"]).otherwise(s["bx"]).alias("x0"),
            F.when(right, s["ay"]).otherwise(s["by"]).alias("y0"),
            F.when(right, s["bx"]).otherwise(s["ax"]).alias("x1"),
            F.when(right, s["by"]).otherwise(s["ay"]).alias("y1"),
            (F.signum(s["ax"] - s["bx"]) * F.col("_turn")).cast("int").alias("sign"),
        )
    )


def _area() -> Column:
    return F.sum(
        F.col("sign")
        * (F.col("x1") - F.col("x0"))
        * (F.col("y0") + F.col("y1"))
        / 2.0
    )


def layer_area(edges: DataFrame) -> DataFrame:
    """Area per id of a layer."""
    return edges.groupBy("id").agg(_area().alias("area"))


def _once_each(edges: DataFrame, keys: DataFrame, part: str, key: str) -> DataFrame:
    """``keys`` without parts whose outline the key has already.  Outlines are
    compared by sums of edge hashes, so no outline is gathered."""
    content = F.xxhash64("x0", "y0", "x1", "y1", "sign")
    outlines = edges.groupBy(F.col("id").alias(part)).agg(
        F.bit_xor(content).alias("_xor"),
        F.count(F.lit(1)).alias("_edges"),
        F.min("x0").alias("_x"),
        F.min("y0").alias("_y"),
    )
    named = keys.select(part, key).distinct().join(outlines, part)
    return named.groupBy(key, "_xor", "_edges", "_x", "_y").agg(F.min(part).alias(part))


def dissolve_edges(edges: DataFrame, keys: DataFrame, part: str, key: str) -> DataFrame:
    """Merge parts that share a key into one shape, as an edge table.

    ``keys`` maps ``part`` (an id of the layer) to ``key``.  Edges shared by
    two neighbours have opposite signs and vanish, so a merged shape is only
    its outline however many parts it has, and no row ever holds a whole group.
    Upright shared edges pass twice and vanish by count.

    A part that a key lists again, under its own id or another, counts once.
    Parts that otherwise overlap along an edge are an error.
    """
    keys = _once_each(edges, keys, part, key)
    named = lookup_join(
        edges.withColumnRenamed("id", part), keys.select(part, key), [part], "inner"
    ).where(F.col(key).isNotNull())
    y_low = F.least("y0", "y1")
    upright = F.col("x0") == F.col("x1")
    ends = (
        F.col("x0").alias("x0"),
        F.when(upright, y_low).otherwise(F.col("y0")).alias("y0"),
        F.col("x1").alias("x1"),
        F.when(upright, F.greatest("y0", "y1")).otherwise(F.col("y1")).alias("y1"),
    )
    merged = named.groupBy(F.col(key).alias("id"), *ends).agg(
        F.sum("sign").cast("int").alias("sign"),
        F.count(F.lit(1)).alias("_times"),
    )
    overlap = F.concat(F.lit("parts overlap under "), F.col("id").cast("string"))
    merged = merged.withColumn(
        "sign",
        F.when(F.abs("sign") > 1, F.raise_error(overlap).cast("int")).otherwise(
            F.col("sign")
        ),
    )
    return merged.where(
        (F.col("sign") != 0)
        | ((F.col("x0") == F.col("x1")) & (F.col("_times") % 2 == 1))
    ).drop("_times")


def dissolve_attributes(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Other columns of a dissolved layer: the value of the first part."""
    rest = [c for c in df.columns if c not in (key, ordinal)]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.min_by(c, ordinal).alias(c) for c in rest]
    )


# --------------------------------------------------------------------------
# Candidate pairs
# --------------------------------------------------------------------------


def _boxes(edges: DataFrame, *more: Column) -> DataFrame:
    box = edges.groupBy("id").agg(
        F.min("x0").alias("xmin"),
        F.max("x1").alias("xmax"),
        F.min(F.least("y0", "y1")).alias("ymin"),
        F.max(F.greatest("y0", "y1")).alias("ymax"),
        *more,
    )
    return _leveled(box)


def _leveled(box: DataFrame) -> DataFrame:
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    level = F.when(side > 0, F.ceil(F.log2(side))).otherwise(F.lit(_LOWEST))
    return box.withColumn(
        "level",
        F.least(F.greatest(level, F.lit(_LOWEST)), F.lit(_HIGHEST)).cast("int"),
    )


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def _covered(boxes: DataFrame, level: Column) -> DataFrame:
    """One row per cell of ``level`` that a box touches; at the box's own level
    or above there are at most four."""
    return (
        boxes.withColumn("lv", level)
        .withColumn(
            "cx",
            F.explode(
                F.sequence(
                    _cell(F.col("xmin"), F.col("lv")), _cell(F.col("xmax"), F.col("lv"))
                )
            ),
        )
        .withColumn(
            "cy",
            F.explode(
                F.sequence(
                    _cell(F.col("ymin"), F.col("lv")), _cell(F.col("ymax"), F.col("lv"))
                )
            ),
        )
    )


def _levels(boxes: DataFrame) -> Column:
    """The levels in use, as a scalar array: at most a hundred small numbers."""
    return boxes.agg(F.array_sort(F.collect_set("level"))).scalar()


def _meet(fine: DataFrame, coarse: DataFrame, strict: bool) -> DataFrame:
    """Pairs of overlapping boxes in which ``fine`` is at or below (``strict``:
    below) the level of ``coarse``.  Areas, and the edge widths of ``coarse``, go
    along where the boxes have them.

    A pair meets in each common cell and is kept only in the one that holds the
    lower left corner of the common box, so no distinct is needed.  A cell of
    level L holds only coarse shapes about 2**L wide, however many tiny shapes
    of the other side crowd into it.  Both tables are stored ones.
    """
    lv = F.col("_lv")
    allowed = lv > F.col("level") if strict else lv >= F.col("level")
    f = _covered(
        fine.withColumn("_lv", F.explode(_levels(coarse))).where(allowed), lv
    ).drop("_lv", "level", "widths")
    c = _covered(coarse, F.col("level")).drop("level")
    prefix = ("id", "xmin", "xmax", "ymin", "ymax", "area")
    c = c.withColumnsRenamed({p: f"c_{p}" for p in prefix})
    cells = ["lv", "cx", "cy"]
    pairs = lookup_join(f, c, cells, "inner", fits_stored(coarse, _CELLS))
    xlo = F.greatest("xmin", "c_xmin")
    ylo = F.greatest("ymin", "c_ymin")
    more = {"area": "f_area", "c_area": "c_area", "widths": "widths"}
    return pairs.where(
        (xlo <= F.least("xmax", "c_xmax"))
        & (ylo <= F.least("ymax", "c_ymax"))
        & (_cell(xlo, F.col("lv")) == F.col("cx"))
        & (_cell(ylo, F.col("lv")) == F.col("cy"))
    ).select(
        F.col("id").alias("f"),
        F.col("c_id").alias("c"),
        xlo.alias("xlo"),
        F.least("xmax", "c_xmax").alias("xhi"),
        ylo.alias("ylo"),
        *[F.col(column).alias(name) for column, name in more.items() if column in pairs.columns],
    )


# --------------------------------------------------------------------------
# Slabs: upright strips.  An edge lies in strips as wide as itself, so it never
# has more than two, however wide the layer's other edges are; edges of unlike
# width meet in the strips of the wider one.
# --------------------------------------------------------------------------

_SLAB_LEVELS = 16  # narrower edges than 2**-16 of the widest share a level


def _exact_levels(layer: DataFrame) -> list[int]:
    """Width levels of a layer's edges, at most about a hundred small numbers."""
    width = F.col("x1") - F.col("x0")
    return (
        layer.where(width > 0)
        .agg(F.collect_set(F.ceil(F.log2(width)).cast("int")).alias("levels"))
        .first()["levels"]
    )


def _common_levels(exact: Sequence[Sequence[int]]) -> list[list[int]]:
    """The slab levels each layer uses, at most _SLAB_LEVELS + 1; the common top
    decides what counts as narrow."""
    top = max((x for found in exact for x in found), default=0)
    low = max(_LOWEST, top - _SLAB_LEVELS)
    return [sorted({max(x, low) for x in found} | {low}) for found in exact]


def _width_levels(*layers: DataFrame) -> list[list[int]]:
    return _common_levels([_exact_levels(layer) for layer in layers])


def _slab_level(levels: list[int]) -> Column:
    width = F.col("x1") - F.col("x0")
    level = F.when(width > 0, F.ceil(F.log2(width))).otherwise(levels[0])
    return F.greatest(level, F.lit(levels[0])).cast("int")


def _in_slabs(edges: DataFrame) -> DataFrame:
    """One row per slab of level ``lv`` that an edge touches."""
    return edges.withColumn(
        "slab",
        F.explode(F.sequence(_cell(F.col("x0"), F.col("lv")), _cell(F.col("x1"), F.col("lv")))),
    )


def _at_wider(edges: DataFrame, levels: list[int]) -> DataFrame:
    """Edges in the slabs of those ``levels`` that are above their own."""
    wider = F.filter(F.array(*map(F.lit, levels)), lambda x: x > F.col("level"))
    return _in_slabs(edges.withColumn("lv", F.explode(wider)))


def _at_own(edges: DataFrame) -> DataFrame:
    return _in_slabs(edges.withColumn("lv", F.col("level")))


_EDGE = ("x0", "y0", "x1", "y1", "sign")
_NOTHING = 1e-9  # share of the smaller shape below which an overlap is rounding


def _edge_meetings(
    pairs: DataFrame, fine: DataFrame, coarse: DataFrame, levels: list[list[int]]
) -> DataFrame:
    """The edge pairs of stored pairs of shapes, each once.

    Two edges meet in the slabs of the wider one: ``wider`` says whether that is
    the fine shape's.  Each plan below has its inputs once.  A key that fills a
    shuffled part of the second join is split by the adaptive skew join, so the
    many edges that it has need not be counted first.
    """
    low = levels[0][0]  # of both layers

    def named(edges: DataFrame, side: str) -> DataFrame:
        return edges.withColumnsRenamed({"id": side, **{c: f"{side}_{c}" for c in _EDGE}})

    def leveled(edges: DataFrame, used: list[int]) -> DataFrame:
        return edges.where("x0 <> x1").withColumn("level", _slab_level(used))

    def at(level: Column, wider: bool) -> Column:
        return F.struct(level.alias("lv"), F.lit(wider).alias("wider"))

    f = lookup_join(pairs, named(leveled(fine, levels[0]), "f"), ["f"], "inner", fits_stored(fine))
    # an edge beside the common box meets nothing there
    f = f.where((F.col("f_x1") > F.col("xlo")) & (F.col("f_x0") < F.col("xhi")))
    # an edge goes to the levels of the shape it is paired with, not of all its layer
    own, used = F.col("level"), F.transform("widths", lambda x: F.greatest(x, F.lit(low)))
    there = F.transform(
        F.filter(F.array_distinct(used), lambda x: x >= F.col("level")), lambda x: at(x, False)
    )
    here = F.when(F.array_min(used) < own, F.array(at(own, True)))
    f = f.select("*", F.inline(F.concat(there, F.coalesce(here, F.slice(there, 1, 0)))))
    ends = _cell(F.greatest("f_x0", "xlo"), F.col("lv")), _cell(F.least("f_x1", "xhi"), F.col("lv"))
    f = f.drop("level", "widths").withColumn("slab", F.explode(F.sequence(*ends)))

    edges = leveled(coarse, levels[1])
    c = (
        _at_own(edges).withColumn("wider", F.lit(False))
        .unionByName(_at_wider(edges, levels[0]).withColumn("wider", F.lit(True)))
    )
    c = named(c.drop("level"), "c")
    small = fits_stored(coarse, 2 * max(map(len, levels)))
    met = f.join(F.broadcast(c) if small else c.hint("merge"), ["c", "wider", "lv", "slab"])
    lo, hi = F.greatest("f_x0", "c_x0"), F.least("f_x1", "c_x1")
    return met.where((lo < hi) & (_cell(lo, F.col("lv")) == F.col("slab"))).select(
        "f", "c", "f_area", "c_area", "ylo", lo.alias("lo"), hi.alias("hi"),
        *[f"{side}_{column}" for side in "fc" for column in _EDGE],
    )


@dataclass(frozen=True)
class Layer:
    """An edge table stored with what every overlay of it needs: the box of each
    shape with its area and the widths of its edges."""

    edges: DataFrame
    boxes: DataFrame
    areas: DataFrame
    levels: tuple[int, ...]
    met: dict = field(default_factory=dict, compare=False)  # overlaps with other layers


def stored_layer(edges: DataFrame | Layer) -> Layer:
    """Edges, boxes and areas of a layer, worked out once and written."""
    if isinstance(edges, Layer):
        return edges
    edges = pin(edges)
    width = F.col("x1") - F.col("x0")
    widths = F.collect_set(F.when(width > 0, F.ceil(F.log2(width)).cast("int")))
    boxes = pin(_boxes(edges, _area().alias("area"), widths.alias("widths")))
    return Layer(edges, boxes, boxes.select("id", "area"), tuple(_exact_levels(edges)))


def overlap_area(a: DataFrame | Layer, b: DataFrame | Layer) -> DataFrame:
    """``(a, b, area)`` of every pair of shapes with a common area.

    For two indicators that are sums over edges the common area is the double
    sum of ``sign_i * sign_j * integral(min(y_i, y_j))`` over the common x
    range of two edges.  Heights count from the bottom of the common box, so
    large coordinates lose no digits; an overlap below a billionth of the
    smaller shape is rounding.  A layer given as ``Layer`` is not read from its
    source again, and what two of them have in common is stored with them.
    """
    return _overlaps(a, b).select("a", "b", "area")


def _overlaps(a: DataFrame | Layer, b: DataFrame | Layer) -> DataFrame:
    """``overlap_area`` with the areas ``a_area`` and ``b_area`` of both shapes."""
    if not (isinstance(a, Layer) and isinstance(b, Layer)):
        return _common(stored_layer(a), stored_layer(b))
    if id(b) not in a.met:
        found = pin(_common(a, b))
        turned = found.select(
            F.col("b").alias("a"), F.col("a").alias("b"), "area",
            F.col("b_area").alias("a_area"), F.col("a_area").alias("b_area"),
        )
        a.met[id(b)], b.met[id(a)] = (b, found), (a, turned)
    return a.met[id(b)][1]


def _common(one: Layer, other: Layer) -> DataFrame:
    a, b = one.edges, other.edges
    levels = _common_levels([one.levels, other.levels])
    up = pin(_meet(one.boxes, other.boxes, strict=False))
    down = pin(_meet(other.boxes, one.boxes, strict=True))

    def turned(met: DataFrame, f: str, c: str) -> DataFrame:
        return met.withColumnsRenamed({"f": f, "c": c, "f_area": f"{f}_area", "c_area": f"{c}_area"})

    met = turned(_edge_meetings(up, a, b, levels), "a", "b").unionByName(
        turned(_edge_meetings(down, b, a, levels[::-1]), "b", "a")
    )

    def height(side: str, x: str) -> Column:
        x0, y0, x1, y1 = (F.col(f"{side}_{c}") for c in _EDGE[:4])
        return (y0 - F.col("ylo")) + (y1 - y0) * (F.col(x) - x0) / (x1 - x0)

    met = met.select(
        "a",
        "b",
        "a_area",
        "b_area",
        (F.col("f_sign") * F.col("c_sign")).alias("sign"),
        (F.col("hi") - F.col("lo")).alias("w"),
        height("f", "lo").alias("a0"),
        height("f", "hi").alias("a1"),
        height("c", "lo").alias("b0"),
        height("c", "hi").alias("b1"),
    )
    w, d0, d1 = F.col("w"), F.col("a0") - F.col("b0"), F.col("a1") - F.col("b1")
    gap = F.when(d0 * d1 >= 0, w * F.abs(d0 + d1) / 2.0).otherwise(
        w * (d0 * d0 + d1 * d1) / (2.0 * (F.abs(d0) + F.abs(d1)))
    )
    lower = (
        w * (F.col("a0") + F.col("a1") + F.col("b0") + F.col("b1")) / 4.0 - gap / 2.0
    )
    common = met.groupBy("a", "b").agg(
        F.sum(F.col("sign") * lower).alias("area"),
        F.first("a_area").alias("a_area"),  # the same on all rows of a pair
        F.first("b_area").alias("b_area"),
    )
    least = F.least(F.abs("a_area"), F.abs("b_area"))
    return common.where(F.col("area") > least * _NOTHING)


def points_within(points: DataFrame, layer: DataFrame) -> DataFrame:
    """``(point, id)`` for every point strictly inside a shape of the layer.

    ``points`` has ``point, x, y`` with one row per point id.  Each point looks
    up one cell per level in use, then only the edges in its own slabs; a point
    on an edge is outside.
    """
    layer = pin(layer)
    boxes = pin(_boxes(layer))
    at = (
        points.select("point", "x", "y")
        .withColumn("lv", F.explode(_levels(boxes)))
        .withColumn("cx", _cell(F.col("x"), F.col("lv")))
        .withColumn("cy", _cell(F.col("y"), F.col("lv")))
    )
    cells = _covered(boxes, F.col("level")).drop("level")
    small = fits_stored(boxes, _CELLS)
    near = lookup_join(at, cells, ["lv", "cx", "cy"], "inner", small).where(
        F.col("x").between(F.col("xmin"), F.col("xmax"))
        & F.col("y").between(F.col("ymin"), F.col("ymax"))
    )

    levels = _width_levels(layer)[0]
    cut = _at_own(layer.withColumn("level", _slab_level(levels))).drop("level")
    used = F.array(*map(F.lit, levels))
    near = near.select("point", "x", "y", "id")
    if not small:
        near = pin(near)  # its keys are counted before it is joined
    near = near.withColumn("lv", F.explode(used)).withColumn(
        "slab", _cell(F.col("x"), F.col("lv"))
    )
    met = lookup_join(near, cut, ["id", "lv", "slab"], "inner", fits_stored(layer, 2))

    x, y = F.col("x"), F.col("y")
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    line = y0 + (y1 - y0) * F.coalesce(F.try_divide(x - x0, x1 - x0), _zero())
    upright = x0 == x1
    touches = F.when(
        upright, (x == x0) & y.between(F.least(y0, y1), F.greatest(y0, y1))
    ).otherwise(x.between(x0, x1) & (y == line))
    crosses = ~upright & (x >= x0) & (x < x1) & (y < line)
    return (
        met.where(touches | crosses)
        .groupBy("point", "id")
        .agg(
            F.sum(F.when(crosses, F.lit(1)).otherwise(F.lit(0))).alias("_n"),
            F.max(touches).alias("_on"),
        )
        .where((F.col("_n") % 2 == 1) & ~F.col("_on"))
        .select("point", "id")
    )


def locate_layers(points: DataFrame, layers: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of the shapes each point lies in, one column per layer; null where a
    layer has none, several rows where layers overlap themselves."""
    found = points.select("point")
    for name, layer in layers.items():
        hits = points_within(points, layer).withColumnRenamed("id", name)
        found = found.join(hits, "point", "left")
    return found.distinct()


def overlay_ratios(
    source: DataFrame | Layer, target: DataFrame | Layer, source_id: str, target_id: str
) -> DataFrame:
    """Share of each source's area that lies in each target, four digits."""
    return _overlaps(source, target).select(
        F.col("a").alias(source_id),
        F.col("b").alias(target_id),
        F.bround(F.col("area") / F.col("a_area"), 4).alias("AREA_RATIO"),
    )

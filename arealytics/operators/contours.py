"""Rings out of an edge table.

Signed edges are turned so that the shape lies to their left; upright edges
follow from what the others leave open at each height of a line.  Every edge
then points to its successor, and pointers are doubled: after k rounds an edge
knows the smallest edge among the 2**k that follow it and how far away it is.
Once nothing changes, that edge names the ring and the distance is the place in
it, after as many rounds as the longest ring has binary digits.  A ring that
runs clockwise is a hole of the smallest outer ring around it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from arealytics.operators.geometry import (
    _origin,
    _sides,
    _twice_area,
    interior_point,
    points_within,
    rings_from_points,
    to_edges,
)
from arealytics.session import pin


def _directed(edges: DataFrame) -> DataFrame:
    """(id, sx, sy, ex, ey) with the shape to the left."""
    leftward = F.col("sign") > 0
    sloped = edges.where("sign <> 0").select(
        "id",
        F.when(leftward, F.col("x1")).otherwise(F.col("x0")).alias("sx"),
        F.when(leftward, F.col("y1")).otherwise(F.col("y0")).alias("sy"),
        F.when(leftward, F.col("x0")).otherwise(F.col("x1")).alias("ex"),
        F.when(leftward, F.col("y0")).otherwise(F.col("y1")).alias("ey"),
    )
    arriving = sloped.select("id", F.col("ex").alias("x"), F.col("ey").alias("y"), F.lit(1).alias("n"))
    leaving = sloped.select("id", F.col("sx").alias("x"), F.col("sy").alias("y"), F.lit(-1).alias("n"))
    open_ends = (
        arriving.unionByName(leaving).groupBy("id", "x", "y").agg(F.sum("n").alias("n")).where("n <> 0")
    )
    # the unbalanced corners of one shape on one upright line
    line = Window.partitionBy("id", "x").orderBy("y")
    flows = open_ends.select(
        "id",
        "x",
        "y",
        F.sum("n").over(line).alias("up"),
        F.lead("y").over(line).alias("above"),
    ).where("up <> 0 AND above IS NOT NULL")
    rising = F.col("up") > 0
    upright = flows.withColumn(
        "_n", F.explode(F.array_repeat(F.lit(1), F.abs("up").cast("int")))
    ).select(
        "id",
        F.col("x").alias("sx"),
        F.when(rising, F.col("y")).otherwise(F.col("above")).alias("sy"),
        F.col("x").alias("ex"),
        F.when(rising, F.col("above")).otherwise(F.col("y")).alias("ey"),
    )
    return sloped.unionByName(upright)


def _successors(directed: DataFrame) -> DataFrame:
    """(edge, next): where several edges leave a corner, the leftmost turn, so
    parts that touch in a corner stay rings of their own."""
    after = directed.select(
        "id",
        F.col("edge").alias("next"),
        F.col("sx").alias("ex"),
        F.col("sy").alias("ey"),
        (F.col("ex") - F.col("sx")).alias("nx"),
        (F.col("ey") - F.col("sy")).alias("ny"),
    )
    dx, dy = F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")
    cross = dx * F.col("ny") - dy * F.col("nx")
    dot = dx * F.col("nx") + dy * F.col("ny")
    back = (cross == 0) & (dot < 0)
    turn = F.when(back, F.lit(-4.0)).otherwise(F.atan2(cross, dot))
    return (
        directed.join(after, ["id", "ex", "ey"])
        .groupBy("edge")
        .agg(F.max_by("next", F.struct(turn, "next")).alias("next"))
    )


def _rank(successors: DataFrame) -> DataFrame:
    """(edge, ring, off): the smallest edge of the ring and the way to it."""
    state = pin(
        successors.select("edge", "next", F.col("edge").alias("ring"), F.lit(0).cast("long").alias("off"))
    )
    reach = 1
    while True:
        ahead = state.select(
            F.col("edge").alias("next"),
            F.col("next").alias("_next"),
            F.col("ring").alias("_ring"),
            F.col("off").alias("_off"),
        )
        better = F.col("_ring") < F.col("ring")
        state = pin(
            state.join(ahead, "next").select(
                "edge",
                F.col("_next").alias("next"),
                F.when(better, F.col("_ring")).otherwise(F.col("ring")).alias("ring"),
                F.when(better, F.col("_off") + reach).otherwise(F.col("off")).alias("off"),
                better.alias("changed"),
            )
        )
        if not state.agg(F.count(F.when(F.col("changed"), 1))).first()[0]:
            return state.select("edge", "ring", "off")
        state, reach = state.drop("changed"), reach * 2


def trace_rings(edges: DataFrame) -> DataFrame:
    """``(id, rings)`` of an edge table, each hole after its outer ring."""
    directed = pin(_directed(edges).withColumn("edge", F.monotonically_increasing_id()))
    ranked = directed.join(_rank(_successors(directed)), "edge")
    # the way to the smallest edge falls along the ring, which begins with it
    corners = F.sort_array(
        F.collect_list(
            F.struct(
                F.when(F.col("off") == 0, F.lit(0)).otherwise(1).alias("a"),
                (-F.col("off")).alias("b"),
                F.struct(F.col("sx").alias("x"), F.col("sy").alias("y")).alias("p"),
            )
        )
    )
    ring = ranked.groupBy("id", "ring").agg(F.transform(corners, lambda c: c["p"]).alias("points"))
    sized = ring.withColumn(
        "area", _twice_area(_sides(F.col("points")), *_origin(F.col("points"))) / 2.0
    ).where("area <> 0")
    sized = pin(sized)
    outer, holes = sized.where("area > 0"), sized.where("area < 0")
    inner = interior_point(rings_from_points(F.col("points")))
    points = holes.select(F.col("ring").alias("point"), inner.alias("_p")).select(
        "point", F.col("_p.x").alias("x"), F.col("_p.y").alias("y")
    )
    layer = to_edges(outer.withColumn("rings", rings_from_points(F.col("points"))), "ring")
    around = (
        points_within(points, layer)
        .join(holes.select(F.col("ring").alias("point"), F.col("id").alias("_of"), "area"), "point")
        .join(outer.select(F.col("ring").alias("id"), F.col("id").alias("_by"), F.col("area").alias("_size")), "id")
        .where("_of = _by AND _size > -area")
        .groupBy("point")
        .agg(F.min_by("id", "_size").alias("outer"))
    )
    placed = sized.join(around, F.col("ring") == F.col("point"), "left").select(
        "id",
        F.struct(
            F.coalesce("outer", "ring").alias("outer"),
            (F.col("area") < 0).alias("hole"),
            "ring",
            "points",
        ).alias("_ring"),
    )
    return placed.groupBy("id").agg(
        F.transform(
            F.sort_array(F.collect_list("_ring")),
            lambda r: F.struct(r["hole"].alias("hole"), r["points"].alias("points")),
        ).alias("rings")
    )

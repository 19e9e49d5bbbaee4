import json
import math
import random
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from arealytics.functions.projection import from_grid, project_grid
from arealytics.operators import geometry as g
from arealytics.operators.contours import trace_rings
from arealytics.operators.crosswalk import build_crosswalk
from arealytics.operators.joins import fits_broadcast, fits_stored
from arealytics.operators.union import union_edges
from arealytics.plans.older import section_points
from arealytics.session import pin
from arealytics.sources.shapes import decode_wkb, read_geojson
from arealytics.sinks import write_geojson

SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
HOLE = [(0.5, 0.5), (0.5, 1.5), (1.5, 1.5), (1.5, 0.5)]


def shape(*rings):
    """Rings as (hole, points); points may run either way round."""
    return [(hole, [tuple(map(float, p)) for p in points]) for hole, points in rings]


def frame(spark, shapes):
    return spark.createDataFrame(list(shapes.items()), f"id string, rings {g.RINGS_TYPE}")


def star(seed, cx, cy, n=9):
    made = random.Random(seed)
    return [
        (cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
        for i in range(n)
        for r in [made.uniform(0.4, 2.0)]
    ]


def inside(points, x, y):
    crossings = 0
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1]):
        if (ax <= x < bx or bx <= x < ax) and y < ay + (by - ay) * (x - ax) / (bx - ax):
            crossings += 1
    return crossings % 2 == 1


def clip(subject, window):
    """Sutherland-Hodgman: subject within a convex counter-clockwise window."""
    for (ax, ay), (bx, by) in zip(window, window[1:] + window[:1]):
        def side(p):
            return (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
        kept = []
        for p, q in zip(subject, subject[1:] + subject[:1]):
            if side(p) >= 0:
                kept.append(p)
            if side(p) * side(q) < 0:
                t = side(p) / (side(p) - side(q))
                kept.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        subject = kept
        if not subject:
            return []
    return subject


def shoelace(points):
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1])) / 2


@pytest.fixture(scope="module")
def layer(spark):
    closed = SQUARE + SQUARE[:1]
    return frame(
        spark,
        {
            "plain": shape((False, closed)),
            "backwards": shape((False, SQUARE[::-1])),
            "holed": shape((False, SQUARE), (True, HOLE)),
            "parts": shape((False, SQUARE), (False, [(5, 5), (6, 5), (6, 7)])),
        },
    )


def test_areas(layer):
    expected = {"plain": 4.0, "backwards": 4.0, "holed": 3.0, "parts": 5.0}
    by_row = dict(layer.select("id", g.ring_area(F.col("rings"))).collect())
    by_edge = dict(g.layer_area(g.to_edges(layer, "id")).collect())
    assert by_row == pytest.approx(expected) and by_edge == pytest.approx(expected)


def test_centroids_and_interior_points(spark, layer):
    found = {
        r["id"]: (r["c"]["x"], r["c"]["y"])
        for r in layer.select("id", g.ring_centroid(F.col("rings")).alias("c")).collect()
    }
    assert found["plain"] == found["backwards"] == pytest.approx((1.0, 1.0))
    assert found["holed"] == pytest.approx((1.0, 1.0))
    bent = {"u": shape((False, [(0, 0), (5, 0), (5, 3), (4, 3), (4, 1), (1, 1), (1, 3), (0, 3)]))}
    stars = {f"s{i}": shape((False, star(i, 0, 0))) for i in range(6)}
    df = frame(spark, bent | stars)
    for r in df.select("id", "rings", g.interior_point(F.col("rings")).alias("p")).collect():
        outline = [(p["x"], p["y"]) for p in r["rings"][0]["points"]]
        assert inside(outline, r["p"]["x"], r["p"]["y"]), r["id"]


def test_points_within_is_strict(spark, layer):
    points = {
        "middle": (1.0, 1.0), "ring": (0.25, 1.0), "corner": (0.0, 0.0), "left": (0.0, 1.0),
        "right": (2.0, 1.0), "top": (1.0, 2.0), "out": (3.0, 1.0), "second": (5.9, 5.5),
        "hole edge": (0.5, 1.0),
    }
    df = spark.createDataFrame([(k, *v) for k, v in points.items()], "point string, x double, y double")
    found = {}
    for point, id_ in g.points_within(df, g.to_edges(layer, "id")).collect():
        found.setdefault(point, set()).add(id_)
    assert found == {
        "middle": {"plain", "backwards", "parts"},
        "ring": {"plain", "backwards", "holed", "parts"},
        "hole edge": {"plain", "backwards", "parts"},
        "second": {"parts"},
    }


@pytest.mark.parametrize("small", [True, False])
def test_points_within_brute_force(spark, small, request):
    if not small:
        request.getfixturevalue("no_broadcast")
    made = random.Random(1)
    outlines = {f"s{i}": star(i, made.uniform(-4, 4), made.uniform(-4, 4)) for i in range(12)}
    outlines["tiny"] = [(x / 500, y / 500) for x, y in star(99, 0, 0)]
    # a third of the points in one spot
    points = [(i, made.uniform(-6, 6), made.uniform(-6, 6)) if i % 3 else (i, 1e-4 * i / 300, 0.0) for i in range(300)]
    df = spark.createDataFrame(points, "point int, x double, y double")
    edges = g.to_edges(frame(spark, {k: shape((False, v)) for k, v in outlines.items()}), "id")
    expected = sorted((p, k) for p, x, y in points for k, v in outlines.items() if inside(v, x, y))
    assert rows(g.points_within(df, edges)) == expected


def test_overlap_against_clipping(spark):
    stars = {f"s{i}": star(i, i % 4, i // 4 * 1.3) for i in range(8)}
    boxes = {
        f"b{i}": [(x + 0.2, y - 0.4), (x + 1.7, y - 0.4), (x + 1.7, y + 0.9), (x + 0.2, y + 0.9)]
        for i, (x, y) in enumerate([(0, 0), (1, 1), (2.5, 0.5), (-3, -3), (40, 40)])
    }
    boxes["big"] = [(-50.0, -50.0), (60.0, -50.0), (60.0, 60.0), (-50.0, 60.0)]
    a = g.to_edges(frame(spark, {k: shape((False, v)) for k, v in stars.items()}), "id")
    b = g.to_edges(frame(spark, {k: shape((False, v)) for k, v in boxes.items()}), "id")
    found = {(r["a"], r["b"]): r["area"] for r in g.overlap_area(a, b).collect()}
    expected = {(s, w): shoelace(clip(sp, wp)) for s, sp in stars.items() for w, wp in boxes.items() if clip(sp, wp)}
    expected = {k: v for k, v in expected.items() if v > 1e-9}
    assert found == pytest.approx(expected)
    back = {(r["b"], r["a"]): r["area"] for r in g.overlap_area(b, a).collect()}
    assert back == pytest.approx(found)


def test_overlap_with_itself_and_holes(spark, layer, no_broadcast):
    edges = g.to_edges(layer, "id")
    found = {(r["a"], r["b"]): r["area"] for r in g.overlap_area(edges, edges).collect()}
    assert found[("holed", "holed")] == pytest.approx(3.0)
    assert found[("plain", "holed")] == pytest.approx(3.0)
    assert found[("parts", "parts")] == pytest.approx(5.0)


def test_touching_shapes_do_not_overlap(spark):
    pair = frame(spark, {"l": shape((False, SQUARE)), "r": shape((False, [(2, 0), (4, 0), (4, 2), (2, 2)]))})
    edges = g.to_edges(pair, "id")
    assert rows(g.overlap_area(edges.where("id = 'l'"), edges.where("id = 'r'"))) == []


def test_overlap_at_state_coordinates(spark):
    """A jittered grid of one-mile cells meets only itself."""
    made = random.Random(7)
    cells = {}
    for i in range(8):
        for j in range(8):
            x, y = 41_000.123 + 1609.344 * i, -214_000.456 + 1609.344 * j
            corners = [(x, y), (x + 1609.344, y), (x + 1609.344, y + 1609.344), (x, y + 1609.344)]
            cells[f"{i}{j}"] = shape((False, [(a + made.uniform(-1e-9, 1e-9), b + made.uniform(-1e-9, 1e-9)) for a, b in corners]))
    edges = g.to_edges(frame(spark, cells), "id")
    found = g.overlap_area(edges, edges).collect()
    assert len(found) == 64 and all(r["a"] == r["b"] for r in found)
    assert all(r["area"] == pytest.approx(1609.344**2, rel=1e-9) for r in found)


@pytest.mark.parametrize("lean", [1e-3, 1e-9])
def test_leaning_sides(spark, lean):
    """Nearly upright sides neither multiply edges nor change results."""
    cells = {
        f"{i}{j}": shape((False, [(i, j), (i + 1, j), (i + 1 + lean, j + 1), (i + lean, j + 1)]))
        for i in range(4) for j in range(4)
    }
    edges = g.to_edges(frame(spark, cells), "id")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.5, 3.25), (3, 9.0, 9.0)], "point int, x double, y double")
    assert rows(g.points_within(points, edges)) == [(1, "00"), (2, "23")]
    found = {(r["a"], r["b"]): r["area"] for r in g.overlap_area(edges, edges).collect()}
    assert {k: v for k, v in found.items() if v > 0.5} == pytest.approx({(k, k): 1.0 for k in cells})
    assert len(found) == 16


def test_dissolve_removes_shared_edges(spark):
    cells = {
        f"{i}{j}": shape((False, [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]))
        for i in range(3) for j in range(2)
    }
    keys = spark.createDataFrame(
        [(k, "all") for k in cells if k != "21"] + [("21", None)], "part string, zone string"
    )
    merged = g.dissolve_edges(g.to_edges(frame(spark, cells), "id"), keys, "part", "zone")
    assert dict(g.layer_area(merged).collect()) == {"all": 5.0}
    # outline only: 5 flat edges, 5 upright edges
    assert merged.where("sign <> 0").count() == 6 and merged.where("sign = 0").count() == 4
    points = spark.createDataFrame([("seam", 1.0, 1.0), ("out", 2.5, 1.5)], "point string, x double, y double")
    assert rows(g.points_within(points, merged)) == [("seam", "all")]


def test_crosswalk_sums_to_one(spark):
    stars = {f"s{i}": shape((False, star(i, i % 4, i // 4))) for i in range(8)}
    grid = {
        f"{i}{j}": shape((False, [(i * 1.5, j * 1.5), (i * 1.5 + 1.5, j * 1.5), (i * 1.5 + 1.5, j * 1.5 + 1.5), (i * 1.5, j * 1.5 + 1.5)]))
        for i in range(-2, 5) for j in range(-2, 5)
    }
    out = build_crosswalk(g.to_edges(frame(spark, stars), "id"), g.to_edges(frame(spark, grid), "id"), "s", "t")
    sums = out.groupBy("s").agg(F.sum("AREA_RATIO").alias("total")).collect()
    assert len(sums) == 8 and all(r["total"] == pytest.approx(1.0) for r in sums)


def test_no_nested_loops(spark, layer, capsys):
    edges = g.to_edges(layer, "id")
    points = layer.select(F.col("id").alias("point"), F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    g.overlap_area(edges, edges).explain()
    g.points_within(points, edges).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_overlay_plan_holds_each_step_once(spark, no_broadcast):
    """Joins that count their hot keys name their left side three times over; one
    behind the other they made plans that filled the driver."""
    shapes = [(f"s{i}", square(0.4 * i, 0.0, 0.5 + i % 3)) for i in range(12)]
    layers = [g.to_edges(frame(spark, {n: shape((False, c)) for n, c in shapes}), "id") for _ in range(2)]
    ratios = g.overlay_ratios(*layers, "s", "t")
    plan = ratios._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("Relation [") <= 20
    found = {(r["s"], r["t"]): r["AREA_RATIO"] for r in ratios.collect()}
    assert found["s0", "s0"] == 1.0 and found["s0", "s1"] == pytest.approx(0.2)


def test_layers_are_met_once_for_both_ways(spark, monkeypatch):
    shapes = [{f"{n}{i}": shape((False, square(at * i, 0.1 * i, side))) for i in range(4)} for n, at, side in (("s", 0.7, 1.0), ("t", 0.9, 1.5))]
    edges = [g.to_edges(frame(spark, some), "id") for some in shapes]
    layers, common, met = [g.stored_layer(e) for e in edges], g._common, []
    monkeypatch.setattr(g, "_common", lambda a, b: met.append(1) or common(a, b))
    there, back = g.overlay_ratios(*layers, "s", "t"), g.overlay_ratios(*layers[::-1], "t", "s")
    assert len(met) == 1
    assert sorted(there.collect()) == sorted(g.overlay_ratios(*edges, "s", "t").collect())
    assert sorted(back.collect()) == sorted(g.overlay_ratios(*edges[::-1], "t", "s").collect())
    assert there.count() > 4


def test_size_checks_go_by_rows(spark, capsys):
    """A layer whose files are small, as its values repeat, is not broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    sides = [(0, 0, 1, 0, 1), (0, 0, 0, 1, 0), (1, 0, 1, 1, 0), (0, 1, 1, 1, -1)]
    columns = ["x0", "y0", "x1", "y1"]
    made = F.array(
        *[
            F.struct(*[F.lit(float(v)).alias(c) for v, c in zip(x, columns)], F.lit(x[4]).alias("sign"))
            for x in sides
        ]
    )
    many = spark.range(20000).select(F.col("id").cast("string").alias("id"), F.inline(made))
    stored = pin(many)
    points = spark.createDataFrame([("in", 0.5, 0.5), ("out", 3.0, 0.5)], "point string, x double, y double")
    try:
        spark.conf.set(name, "2m")
        assert fits_broadcast(stored) and not fits_stored(stored)
        found = g.points_within(points, stored)
        found.explain()
        plan = capsys.readouterr().out
        assert found.groupBy("point").count().collect() == [("in", 20000)]
    finally:
        spark.conf.set(name, before)
    assert any("SortMergeJoin" in line and "slab" in line for line in plan.splitlines())


def test_boxes_meet_without_broadcast_of_many(spark, capsys):
    """Overlays look at the number of boxes too, not at the size of their files."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    x = F.col("id").cast("double") % 10
    boxes = pin(
        spark.range(20000).select(
            F.col("id").cast("string").alias("id"), x.alias("xmin"), (x + 1.0).alias("xmax"),
            F.lit(0.0).alias("ymin"), F.lit(1.0).alias("ymax"), F.lit(0).alias("level"),
        )
    )
    one = pin(boxes.where("id = '3'"))
    try:
        spark.conf.set(name, "2m")
        assert fits_broadcast(boxes)
        met = g._meet(one, boxes, strict=False)
        met.explain()
        plan = capsys.readouterr().out
        assert met.count() == 6000  # those that end, start or lie there
    finally:
        spark.conf.set(name, before)
    assert any("SortMergeJoin" in line and "cx" in line for line in plan.splitlines())


def _wkb(polygons, order="<", z=False, multi=False):
    flag = 1 if order == "<" else 0

    def one(rings):
        out = struct.pack(order + "BI", flag, 1003 if z else 3) + struct.pack(order + "I", len(rings))
        for ring in rings:
            out += struct.pack(order + "I", len(ring))
            for p in ring:
                out += struct.pack(order + ("ddd" if z else "dd"), *p, *([9.0] if z else []))
        return out

    if not multi:
        return one(polygons[0])
    head = struct.pack(order + "BI", flag, 1006 if z else 6)
    return head + struct.pack(order + "I", len(polygons)) + b"".join(map(one, polygons))


def test_wkb(spark):
    far = [(5.0, 5.0), (6.0, 5.0), (6.0, 7.0), (5.0, 5.0)]
    df = spark.createDataFrame(
        [
            ("a", _wkb([[SQUARE, HOLE]])),
            ("b", _wkb([[SQUARE, HOLE]], ">")),
            ("c", _wkb([[SQUARE, HOLE], [far]], z=True, multi=True)),
            ("d", None),
        ],
        "id string, geometry binary",
    )
    out = {r["id"]: r["rings"] for r in decode_wkb(df).collect()}
    assert [x["hole"] for x in out["c"]] == [False, True, False] and out["d"] == []
    assert [(p["x"], p["y"]) for p in out["a"][0]["points"]] == SQUARE
    assert out["a"] == out["b"] == out["c"][:2]


def test_geojson_round_trip(spark, layer, tmp_path):
    path = str(tmp_path / "shapes")
    write_geojson(layer, path, ["id"])
    back = read_geojson(spark, path, ["id"], lines=True)
    expected = dict(layer.select("id", g.ring_area(F.col("rings"))).collect())
    assert dict(back.select("id", g.ring_area(F.col("rings"))).collect()) == expected


def test_geojson_collection(spark, tmp_path):
    path = tmp_path / "one.geojson"
    path.write_text(
        '{"type": "FeatureCollection", "features": [\n'
        '{"type": "Feature", "properties": {"name": "p"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,2],[0,0]]]}},\n'
        '{"type": "Feature", "properties": {"name": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}]}'
    )
    out = read_geojson(spark, str(path), ["name"])
    areas = dict(out.select("name", g.ring_area(F.col("rings"))).collect())
    assert areas == {"p": 2.0, "m": 1.0}


def test_dissolve_counts_a_repeated_part_once(spark):
    parts = {"a": shape((False, SQUARE)), "again": shape((False, SQUARE)), "next": shape((False, [(2, 0), (4, 0), (4, 2), (2, 2)]))}
    edges = g.to_edges(frame(spark, parts), "id")
    keys = spark.createDataFrame([(k, "all") for k in [*parts, "a"]], "part string, zone string")
    merged = g.dissolve_edges(edges, keys, "part", "zone")
    assert dict(g.layer_area(merged).collect()) == {"all": 8.0}


def test_dissolve_rejects_overlapping_parts(spark):
    parts = {"a": shape((False, SQUARE)), "b": shape((False, [(0, 0), (2, 0), (2, 1), (0, 1)]))}
    keys = spark.createDataFrame([(k, "all") for k in parts], "part string, zone string")
    merged = g.dissolve_edges(g.to_edges(frame(spark, parts), "id"), keys, "part", "zone")
    with pytest.raises(Exception, match="parts overlap"):
        merged.collect()


def union_of(spark, parts, keys=None):
    df = frame(spark, {k: shape(*v) for k, v in parts.items()})
    keys = keys or [(k, "all") for k in parts]
    merged = union_edges(g.to_edges(df, "id"), spark.createDataFrame(keys, "_part string, name string"), "_part", "name")
    return merged


def square(x, y, side=1.0):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]


def sampled_area(parts, step=0.02):
    """Share of a fine grid's centres in any part."""
    n, hits = int(8 / step), 0
    for i in range(n):
        for j in range(n):
            x, y = -4 + (i + 0.5) * step, -4 + (j + 0.5) * step
            hits += any(sum(inside([tuple(map(float, p)) for p in ring], x, y) for _, ring in p) % 2 for p in parts)
    return hits * step * step


UNIONS = {
    "shifted": ({"a": [(False, square(0, 0))], "b": [(False, square(0.5, 0))]}, 1.5),
    "diagonal": ({"a": [(False, square(0, 0))], "b": [(False, square(0.5, 0.5))]}, 1.75),
    "nested": ({"a": [(False, square(0, 0, 3))], "b": [(False, square(1, 1))]}, 9.0),
    "shared corner box": ({"a": [(False, square(0, 0, 2))], "b": [(False, square(0, 0))]}, 4.0),
    "plugged hole": ({"a": [(False, SQUARE), (True, HOLE)], "b": [(False, HOLE)]}, 4.0),
    "half plugged": ({"a": [(False, SQUARE), (True, HOLE)], "b": [(False, square(0.75, -1, 3))]}, 10.25),
    "three": ({"a": [(False, square(0, 0))], "b": [(False, square(0.5, 0))], "c": [(False, square(0.25, 0.5))]}, 2.0),
    "apart": ({"a": [(False, square(0, 0))], "b": [(False, square(5, 5))]}, 2.0),
    "uneven border": ({"a": [(False, square(0, 0, 2))], "b": [(False, square(2, 0))], "c": [(False, square(2, 1))]}, 6.0),
    "listed twice": ({"a": [(False, square(0, 0))], "b": [(False, square(0, 0))]}, 1.0),
}


def test_union_of_overlapping_parts(spark):
    everything = {f"{case}/{part}": rings for case, (parts, _) in UNIONS.items() for part, rings in parts.items()}
    merged = union_of(spark, everything, [(name, name.split("/")[0]) for name in everything])
    found = dict(g.layer_area(merged).collect())
    expected = {case: area for case, (_, area) in UNIONS.items()}
    assert found == pytest.approx(expected, abs=1e-9)


def test_union_of_stars(spark):
    parts = {f"s{i}": [(False, star(i, 0.6 * math.cos(i), 0.6 * math.sin(2 * i)))] for i in range(5)}
    merged = union_of(spark, parts).cache()
    (found,) = [r["area"] for r in g.layer_area(merged).collect()]
    assert found == pytest.approx(sampled_area(parts.values()), rel=0.01)
    # every corner of the outline is passed as often in as out
    (traced,) = trace_rings(merged).collect()
    assert sum(1 - 2 * r["hole"] for r in traced["rings"]) >= 1
    again = g.layer_area(g.to_edges(trace_rings(merged), "id")).first()["area"]
    assert again == pytest.approx(found, rel=1e-12)


def test_rings_of_dissolved_layers(spark, tmp_path):
    parts = {
        # a ring of eight squares around a hole with an island in it
        **{f"p{i}{j}": [(False, square(i, j))] for i in range(3) for j in range(3) if (i, j) != (1, 1)},
        "island": [(False, square(1.25, 1.25, 0.5))],
        # two squares that touch in a corner, one apart
        "q1": [(False, square(10, 0))], "q2": [(False, square(11, 1))], "q3": [(False, square(20, 0))],
        "long": [(False, square(30, 0, 2))], "short1": [(False, square(32, 0))], "short2": [(False, square(32, 1))],
        "tri": [(False, [(40, 0), (42, 0), (41, 3)])],
    }
    name = {"p": "frame", "i": "frame", "q": "corner", "l": "uneven", "s": "uneven", "t": "tri"}
    merged = union_of(spark, parts, [(p, name[p[0]]) for p in parts])
    traced = trace_rings(merged).cache()
    found = {r["id"]: [(x["hole"], len(x["points"])) for x in r["rings"]] for r in traced.collect()}
    assert {k: sum(h for h, _ in v) for k, v in found.items()} == {"frame": 1, "corner": 0, "uneven": 0, "tri": 0}
    assert {k: len(v) for k, v in found.items()} == {"frame": 3, "corner": 3, "uneven": 1, "tri": 1}
    # a hole stands after its outer ring, not after the island
    frame_rings = next(r["rings"] for r in traced.collect() if r["id"] == "frame")
    at = [x["hole"] for x in frame_rings].index(True)
    assert max(p["x"] for p in frame_rings[at - 1]["points"]) == 3.0
    area = dict(g.layer_area(merged).collect())
    assert area == pytest.approx({"frame": 8.25, "corner": 3.0, "uneven": 6.0, "tri": 3.0})
    traced.write.parquet(str(tmp_path / "layer"))
    stored = spark.read.parquet(str(tmp_path / "layer"))
    assert dict(stored.select("id", g.ring_area(F.col("rings"))).collect()) == pytest.approx(area)
    write_geojson(traced, str(tmp_path / "json"), ["id"])
    back = read_geojson(spark, str(tmp_path / "json"), ["id"], lines=True)
    assert dict(back.select("id", g.ring_area(F.col("rings"))).collect()) == pytest.approx(area)


def test_rings_of_an_empty_layer(spark):
    empty = g.to_edges(frame(spark, {"x": []}), "id")
    assert trace_rings(empty).collect() == []
    keys = spark.createDataFrame([], "_part string, name string")
    assert union_edges(empty, keys, "_part", "name").collect() == []


def test_overlay_stands_once_in_a_crosswalk(spark):
    shapes = {f"s{i}": shape((False, square(i % 4, i // 4))) for i in range(8)}
    source = g.to_edges(frame(spark, shapes), "id")
    target = g.stored_layer(g.to_edges(frame(spark, {"t": shape((False, square(0.5, 0, 2)))}), "id"))
    out = build_crosswalk(source, target, "s", "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the ratios are read twice from their table; nothing of the overlay is left
    assert plan.count("FileScan") <= 3 and "slab" not in plan
    found = {r["s"]: r["AREA_RATIO"] for r in out.collect()}
    assert set(found) == {"s0", "s1", "s2", "s4", "s5", "s6"} and set(found.values()) == {1.0}


def test_townships_are_named_trimmed_and_merged(spark):
    from arealytics.plans.crosswalks import TOWNSHIP, section_areas, township_edges

    def at(x, y):
        return shape((False, [(-120 + x / 100, 37 + y / 100) for x, y in square(x, y)]))

    rows = [("M", "T1", at(0, 0)), ("M", "T1", at(0.5, 0)), ("M", "T1", at(0, 0)), (" ", "", at(5, 5)),
            (None, "T1", at(7, 7)), ("", "T2 ", at(3, 3))]
    parts = spark.createDataFrame(rows, f"Meridian string, TownshipRange string, rings {g.RINGS_TYPE}")
    area = dict(g.layer_area(township_edges(parts)).collect())
    one = section_areas(frame(spark, {"a": at(0, 0)}).withColumnRenamed("id", "CO_MTRS")).first()["ALAND"]
    assert set(area) == {"M T1", "T2"} and area["T2"] == pytest.approx(one, rel=1e-2)
    assert area["M T1"] > 1.2 * one and TOWNSHIP == "MeridianTownshipRange"


def test_one_document_read_by_several_tasks(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"name": f"f{i}", "note": "a Feature, {\"x\"}", "n": i},
         "geometry": {"type": "Polygon", "coordinates": [square(float(i), 0.0) + [(float(i), 0.0)]]}}
        for i in range(400)
    ]
    features[7]["geometry"] = {"type": "MultiPolygon", "coordinates": [[square(0.0, 9.0)], [square(5.0, 9.0)]]}
    document = {"type": "FeatureCollection", "name": "x", "crs": {"type": "name"}, "features": features, "more": [1]}
    for name, form in {"tight": {"separators": (",", ":")}, "wide": {"indent": 2}}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(document, **form))
        whole = read_geojson(spark, str(path), ["name", "n"])
        setting = "spark.sql.files.maxPartitionBytes"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "8k")
        try:
            split = read_geojson(spark, str(path), ["name", "n"], split=True)
            assert split.rdd.getNumPartitions() > 4
            assert sorted(split.collect()) == sorted(whole.collect()) and split.count() == 400
        finally:
            spark.conf.set(setting, before)


def test_local_grid_round_trip(spark):
    at = [(-120.5, 36.5), (-122.4194, 37.7749), (-119.5, 38.9), (-124.0, 32.6), (-114.2, 41.9)]
    df = spark.createDataFrame(at, "lon double, lat double").withColumn("p", project_grid(F.col("lon"), F.col("lat")))
    found = df.withColumn("q", from_grid(F.col("p.x"), F.col("p.y"))).collect()
    for r in found:
        # a millimetre is about 1e-8 degrees
        assert r["q"]["x"] == pytest.approx(r["lon"], abs=1e-9) and r["q"]["y"] == pytest.approx(r["lat"], abs=1e-9)
    origin = found[0]["p"]
    assert (origin["x"], origin["y"]) == pytest.approx((6561666.6667, 1640416.6667), abs=1e-3)
    # on the standard parallels lengths are true: a short step east
    for parallel in (38 + 26 / 60, 37 + 4 / 60):
        a, b = [
            r["p"] for r in spark.createDataFrame([(-121.0, parallel), (-120.9999, parallel)], "lon double, lat double")
            .select(project_grid(F.col("lon"), F.col("lat")).alias("p")).collect()
        ]
        e2 = 2 / 298.257222101 - 1 / 298.257222101**2
        phi = math.radians(parallel)
        true = 6378137 * math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2) * math.radians(0.0001)
        assert math.hypot(b["x"] - a["x"], b["y"] - a["y"]) * 1200 / 3937 == pytest.approx(true, rel=1e-7)


def test_points_inside_sections(spark):
    ring = [(-120 + x / 60, 37 + y / 60) for x, y in [(0, 0), (1, 0), (1, 1), (0.2, 1), (0.2, 0.2), (0, 0.2)]]
    sections = frame(spark, {"a": shape((False, ring))}).withColumnRenamed("id", "CO_MTRS")
    (point,) = section_points(sections.unionByName(sections)).collect()
    assert point["point"] == "a" and inside(ring, point["x"], point["y"])

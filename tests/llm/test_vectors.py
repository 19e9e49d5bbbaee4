"""Exact top-k and curve neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealytics.llm import curves, topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s") for i, v in rows], SCHEMA)


ODD_ROWS = [
    (900, None), (901, [float("nan"), 1.0]), (902, [float("inf"), 0.0]), (903, [None, 1.0]),
    (None, [1.0, 1.0]),
]


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(1)
    rows = [(i, random.standard_normal(8).tolist()) for i in range(200)]
    rows += [(200 + i, rows[3][1]) for i in range(12)]  # ties
    rows += [(220, (np.array(rows[4][1]) * 3).tolist()), (240, [0.0] * 8)]
    return rows


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    whole = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(int)
    found = set()
    for q in np.flatnonzero(ids % 20 == 0):
        scores = whole @ whole[q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:k]
        found |= {(ids[q], r + 1, ids[j], scores[j]) for r, j in enumerate(order)}
    return found


@pytest.mark.parametrize("switch", [-1.0, 0.5, 2.0])
def test_top_k_equals_brute_force(spark, vectors, monkeypatch, switch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "GROUP", 64)
    monkeypatch.setattr(topk, "SEED_VECTORS", 8)
    monkeypatch.setattr(topk, "COORDINATE_FROM", switch)
    found = topk.top_k(table(spark, vectors + ODD_ROWS), F.col("vec_id") % 20 == 0, 5)
    assert {tuple(r) for r in found.collect()} == exact(vectors, 5)


def test_search_group_prunes_exactly(vectors, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    rows = [(i, np.floor(64 * np.array(v))) for i, v in vectors]
    ids = np.array([i for i, _ in rows])
    values = np.array([v for _, v in rows])
    lengths = np.linalg.norm(values, axis=1)
    for switch in (-1.0, 0.3, 2.0):
        monkeypatch.setattr(topk, "COORDINATE_FROM", switch)
        best = topk.Best(ids[:30], 4, np.full(30, -np.inf))
        topk.search_group(best, values[:30], lengths[:30], ids, values, lengths)
        for q in range(30):
            scores = (values @ values[q]).astype(int)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:4]
            assert best.found[best.rows == q].tolist() == ids[order].tolist()


def test_large_components_stay_exact():
    a = np.array([[2.0**40, 1.0], [3.0, 2.0**33]])
    assert topk.products(a, a).tolist() == [
        [2**63 - 1, 3 * 2**40 + 2**33], [3 * 2**40 + 2**33, 2**63 - 1]
    ]


def test_few_and_no_candidates(spark):
    two = table(spark, [(0, [1.0, 2.0]), (1, [1.0])])
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") == 0, 9).collect()] == [(0, 1, 1, 4096)]
    none = table(spark, ODD_ROWS[:3])
    assert topk.top_k(none, F.lit(True), 3).count() == 0
    assert curves.nearest(none, F.lit(True), 3).count() == 0
    near = curves.nearest(two, F.col("vec_id") == 0, 9).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in near] == [(0, 1, 1)]


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    places = curves.hilbert(grid, 3)
    assert sorted(places) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_recall_and_ties(spark, vectors):
    rows = [r for r in vectors if r[0] != 240]
    ids = np.array([i for i, _ in rows])
    values = np.array([v for _, v in rows], np.float32).astype(float)
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    found = {}
    asked = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 205)
    for r in curves.nearest(table(spark, vectors + ODD_ROWS), asked, 5).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q in np.flatnonzero((ids % 20 == 0) | (ids == 205)):
        cosines = unit @ unit[q]
        order = [j for j in np.lexsort((ids, -np.round(cosines, 12))) if j != q][:5]
        got = {v for v, _ in found[ids[q]].values()}
        hits += len(got & set(ids[order].tolist()))
        total += 5
        for v, s in found[ids[q]].values():
            assert abs(s - cosines[ids == v][0]) < 1e-12
    assert hits / total >= 0.9
    # equal vectors: the smallest ids other than the query's own
    assert [found[205][r][0] for r in range(1, 6)] == [3, 200, 201, 202, 203]

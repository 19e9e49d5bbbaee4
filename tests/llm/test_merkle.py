"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealytics.llm import merkle
from arealytics.llm.common import remainder

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """(root, for each node its (place, others) by level)."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place - place % 3 : place - place % 3 + 3]
            steps[i].append((place % 3, run[: place % 3] + run[place % 3 + 1 :]))
            at[i] = place // 3
        nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], steps


def expected(rows):
    sources = {}
    for r in rows:
        leaf = digest("".join(map(field, r)))
        changed = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0 and r[4] is not None
        claim = digest("".join(map(field, [*r[:4], r[4].replace("\n", "")]))) if changed else leaf
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, claim, r[0]))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: x[:4])
        trees[s] = climb([x[2] for x in sources[s]])
    root, above = climb([trees[s][0] for s in order])
    found = []
    for s, upper in zip(order, above):
        subroot, steps = trees[s]
        for (_, _, leaf, claim, doc_id), lower in zip(sources[s], steps):
            folded = claim
            for place, others in lower + upper:
                folded = digest("".join([*others[:place], folded, *others[place:]]))
            proof = digest("".join(d for _, others in lower + upper for d in others))
            found.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return found


def check(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(table, remainder("doc_id", 2) == 0, **options).collect()
    assert Counter(map(tuple, found)) == Counter(expected(rows))


def test_sources_levels_and_odd_rows(spark):
    draw = random.Random(4)
    rows = []
    for i in draw.sample(range(-200_000, 400_000, 7), 500):
        source = draw.choice([None, "", "a", "a", "a", "é", "z", "😀"])
        text = draw.choice([None, "", "one\ntwo\n", "words äö", f"line {i}\n" * 3])
        rows.append((i, source, draw.choice([None, "en"]), draw.choice([None, 3, -12]), text))
    rows += [(7, "lone", "en", 1, "only"), (1 << 62, "a", None, None, "far"), (-(1 << 63), "a", None, 0, "low")]
    check(spark, rows)
    check(spark, rows, most=2)  # arrays of nine slots: several stages in both directions


def test_repeated_and_missing_ids(spark):
    rows = [(None, "a", "en", 1, f"text {i % 4}\n") for i in range(30)]
    rows += [(5, "a", "en", 1, "same\n")] * 11 + [(5, "a", "en", 2, "other\n"), (6, "a", None, 2, None)]
    rows += [(i, "b", "en", 1, "x\n") for i in range(20)] + [(5, "b", "en", 1, "y")] * 2
    check(spark, rows, most=2)


def test_many_equal_rows_without_broadcast(spark, no_broadcast):
    check(spark, [(3, "a", "en", 1, "x\n")] * 9000 + [(4, None, "en", 1, "x\n"), (2, "a", "en", 1, "y\n")])


def test_one_row_and_no_rows(spark):
    check(spark, [(1, None, None, None, None)])
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns_are_not_part_of_a_leaf(spark):
    table = spark.createDataFrame([(i, "a", "en", 1, "t") for i in range(5)], SCHEMA)
    extra = table.withColumns({c: F.rand() for c in ("sid", "place", "leaf", "claim", "_part", "n", "bucket")})
    assert sorted(merkle.manifest(extra).collect()) == sorted(merkle.manifest(table).collect())


@pytest.mark.parametrize("share", [0.001, 0.2, 0.9])
def test_ranks_of_lists_and_bits(share):
    draw = np.random.default_rng(int(share * 1000))
    sets = [np.flatnonzero(draw.random(1 << 16) < p) for p in (share, share / 10, share)]
    lows = [merkle._encoded(s) for s in sets]
    assert all(np.array_equal(merkle._decoded(len(s), b), s) for s, b in zip(sets, lows))
    again = [s[::97] for s in sets]
    container = draw.integers(0, 3, 2000)
    low = draw.integers(0, 1 << 16, 2000)
    found = merkle.ranks(
        container, low, [len(s) for s in sets], lows,
        [a.astype(np.uint16).tobytes() for a in again], [np.full(len(a), 4).tobytes() for a in again],
    )
    wanted = [(sets[c] < x).sum() + 4 * (again[c] < x).sum() for c, x in zip(container, low)]
    assert found.tolist() == wanted


def test_broken_proofs_lead_elsewhere():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(14)]
    levels = merkle.reduce_slots(nodes, True)
    for slot, node in enumerate(nodes):
        steps = list(merkle.siblings(merkle.path_of(levels, slot)))
        assert merkle.fold(node, steps) == levels[-1][0]
        assert merkle.fold(nodes[slot - 1], steps) != levels[-1][0]

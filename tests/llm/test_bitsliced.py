"""Lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from arealytics.llm import bitsliced

DOCUMENTS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(documents, items, k):
    counted = [(i, Counter(split(t))) for i, t in documents]
    sizes = [c.total() for _, c in counted]
    n, tokens = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for (doc_id, c), size in zip(counted, sizes):
            m = 75 + 25 * size * n // max(1, tokens)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in split(text) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            found.append((item, rank, doc_id, -score))
    return found


def check(spark, documents, items, k=4, **options):
    found = bitsliced.search(
        spark.createDataFrame(documents, DOCUMENTS), spark.createDataFrame(items, ITEMS), k, **options
    ).collect()
    assert Counter(tuple(r)[:4] for r in found) == Counter(expected(documents, items, k))
    return found


def corpus(size, seed=1):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Straße", "É1", "año", "x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(draw.choices(words, weights, k=draw.randint(1, 120))) for _ in range(size)]
    return list(enumerate(texts)), draw


def test_equal_to_scoring_every_document(spark):
    documents, draw = corpus(700)
    documents += [(9000, None), (9001, ""), (9002, "--- !!"), (9003, "Rare words: W3-w4_w5"), (9004, "w1 " * 5000)]
    items = [(i, " ".join(draw.sample(draw.choice(documents)[1].split(), 1)) + f" w{i} W250 nowhere w1 w1") for i in range(6)
             ] + [(50, "rare WORDS"), (51, None), (52, "..."), (53, "unheard of")]
    found = check(spark, documents, items, at_once=4)
    # most documents are left out without being scored
    assert all(r.candidates < len(documents) / 2 for r in found if r.item_id == 50)


def test_ties_repeated_rows_and_missing_ids(spark):
    documents = [(i % 7, "same words here") for i in range(40)] + [(None, "same words here")] * 3
    documents += [(3, "other words"), (3, "same"), (None, "only once")]
    check(spark, documents, [(1, "same words"), (1, "words"), (None, "once only"), (2, "same words")], k=9)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    check(spark, [(1, None)], [(1, "a")])


def test_clashing_columns(spark):
    documents, _ = corpus(30)
    table = spark.createDataFrame(documents, DOCUMENTS).selectExpr("*", "1 AS item", "2 AS _key", "3 AS items", "4 AS rank")
    items = spark.createDataFrame([(1, "w3 w9")], ITEMS).selectExpr("*", "1 AS score", "5 AS doc_id")
    found = bitsliced.search(table, items, 3).collect()
    assert [tuple(r)[:4] for r in sorted(found)] == expected(documents, [(1, "w3 w9")], 3)


@pytest.mark.parametrize("bits", [2, 12])
def test_bounds_are_never_below_scores(spark, monkeypatch, bits):
    monkeypatch.setattr(bitsliced, "BITS", bits)  # few bits: many false ones
    documents, draw = corpus(300, seed=bits)
    counted = [Counter(bitsliced.terms(t)) for _, t in documents]
    items = bitsliced.Items.of([(i, " ".join(f"w{draw.randint(0, 299)}" for _ in range(12))) for i in range(9)])
    df = np.array([sum(t in c for c in counted) for t in items.vocabulary])
    tokens = sum(c.total() for c in counted)
    items = items.weigh(df, len(counted), tokens)
    bounds = bitsliced.Bounds(items)
    close = total = 0
    for size in {bitsliced.signature_bits(len(c)) for c in counted}:
        block = bitsliced._Block(size)
        members = [c for c in counted if bitsliced.signature_bits(len(c)) == size]
        for c in members:
            block.ids.append(0)
            block.hashes.append(bitsliced.WordHashes().of(list(c)))
            block.tf.append(np.array(list(c.values())))
        row = {k: v[0] for k, v in block.sliced().items()}
        found = bounds.of(row)
        for column, c in enumerate(members):
            m = bitsliced.length_factor(c.total(), len(counted), tokens)
            for item in range(9):
                mine = items.item == item
                exact = sum(
                    int(w) * bitsliced.gain(c[items.vocabulary[t]], m)
                    for t, w in zip(items.term[mine], items.weight[mine]) if items.vocabulary[t] in c
                )
                assert found[item, column] >= exact
                close += found[item, column] <= 1.3 * exact
                total += 1
    assert bits < 12 or close > 0.8 * total

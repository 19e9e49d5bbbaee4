"""The quadratic discriminant: statistics, fit, scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealytics.llm import quality
from arealytics.llm.common import remainder

DOCUMENTS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


def of(text):
    return dict(zip(quality.STATISTICS, quality.statistics(text) / quality.UNIT))


def test_statistics_of_a_text():
    found = of("One two TWO two!! 42\nOne two\nend$")
    log = lambda share: np.log(share + quality.SMALL)
    assert found["words"] == pytest.approx(np.log1p(8), abs=1e-3)
    assert found["word length"] == pytest.approx(np.log1p(np.mean([3, 3, 3, 5, 2, 3, 3, 4])), abs=1e-3)
    assert found["longest word"] == pytest.approx(np.log1p(5), abs=1e-3)
    assert found["upper case"] == pytest.approx(log(5 / 21), abs=1e-3)
    assert found["digits"] == pytest.approx(log(2 / 33), abs=1e-3)
    assert found["exclamations"] == pytest.approx(log(2 / 33), abs=1e-3)
    assert found["symbols"] == pytest.approx(log(1 / 33), abs=1e-3)
    assert found["marked word ends"] == pytest.approx(log(2 / 8), abs=1e-3)
    assert found["different words"] == pytest.approx(log(6 / 8), abs=1e-3)
    assert found["commonest word"] == pytest.approx(log(2 / 8), abs=1e-3)
    assert found["different lines"] == pytest.approx(log(1), abs=1e-3)
    assert found["words a line"] == pytest.approx(np.log1p(8 / 3), abs=1e-3)
    assert of("a a a a")["same word again"] == pytest.approx(log(3 / 4), abs=1e-3)
    assert of("a b a b a b")["different triples"] == pytest.approx(log(2 / 4), abs=1e-3)


def test_odd_texts_have_finite_statistics():
    assert np.array_equal(quality.statistics(None), quality.statistics(""))
    for text in ("", " \n\t ", "!", "\x00", "ä" * 10, "word " * 200_000, "x" * 1_000_000):
        found = quality.statistics(text)
        assert found.shape == (quality.SIZE,) and np.abs(found).max() < 100 * quality.UNIT


def gaussian(rows, mean, covariance):
    apart = rows - mean
    return -0.5 * np.einsum("ij,jk,ik->i", apart, np.linalg.inv(covariance), apart) - 0.5 * np.linalg.slogdet(covariance)[1]


def described(spark, rows, ids):
    data = [(int(i), bytearray(r.astype(np.int32).tobytes())) for i, r in zip(ids, rows)]
    return spark.createDataFrame(data, "doc_id long, statistics binary")


def sample(size=600, seed=2):
    draw = np.random.default_rng(seed)
    good = draw.random(size) < 0.7
    shape = draw.normal(size=(2, quality.SIZE, quality.SIZE)) * 200
    rows = np.where(
        good[:, None], draw.normal(size=(size, quality.SIZE)) @ shape[0],
        draw.normal(size=(size, quality.SIZE)) @ shape[1] + 300,
    )
    return np.rint(rows).astype(np.int64), good


def test_moments_and_scores_equal_a_direct_fit(spark):
    rows, good = sample()
    table = described(spark, rows, range(len(rows)))
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], LABELS)
    model = quality.learn(table, labels, lambda key: remainder(key, 4) != 2)
    trains = np.array([r.t for r in table.orderBy("doc_id").select((remainder("doc_id", 4) != 2).alias("t")).collect()])
    sides = [rows[trains & (good == g)].astype(float) for g in (0, 1)]
    within = [np.cov(s.T, bias=True) for s in sides]
    count = [len(s) for s in sides]
    pooled = (count[0] * within[0] + count[1] * within[1]) / sum(count)
    scale = np.outer(*[np.sqrt(np.maximum(np.diag(pooled), 1))] * 2)
    odds = np.zeros(len(rows))
    for sign, side, w, n in zip((-1, 1), sides, within, count):
        mixed = ((1 - model.to_pooled) * w + model.to_pooled * pooled) / scale
        shrunk = (1 - model.to_identity) * mixed + model.to_identity * np.trace(mixed) / quality.SIZE * np.eye(quality.SIZE)
        odds += sign * (gaussian(rows, side.mean(axis=0), shrunk * scale) + np.log(n / sum(count)))
    found = np.array([r.score for r in quality.score(table, model).orderBy("doc_id").collect()])
    assert found == pytest.approx(1 / (1 + np.exp(-np.clip(odds, -700, 700))), abs=1e-9)
    assert ((found >= 0.5) == good)[~trains].mean() > 0.95


def test_shrinkage_is_the_best_of_the_grid_out_of_fold(spark):
    rows, good = sample(160, seed=5)
    table = described(spark, rows, range(len(rows)))
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], LABELS)
    model = quality.learn(table, labels, lambda key: F.lit(True))
    folds = np.array([
        r.f for r in table.orderBy("doc_id")
        .select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(quality.FOLDS)).alias("f")).collect()
    ])

    def loss(*amounts):
        total = 0.0
        for fold in range(quality.FOLDS):
            some = folds != fold
            classes = [
                quality.Moments(len(s), s.sum(axis=0).astype(float), (s.T @ s).astype(float))
                for s in (rows[some & (good == g)] for g in (0, 1))
            ]
            odds = quality.Discriminant(classes, *amounts).log_odds(rows[~some])
            each = np.logaddexp(0, np.where(good[~some], -odds, odds))
            total += np.minimum(each, quality.WORST).sum()
        return total

    losses = {(a, b): loss(a, b) for a in quality.TO_POOLED for b in quality.TO_IDENTITY}
    assert losses[model.to_pooled, model.to_identity] == pytest.approx(min(losses.values()), abs=1e-3)


def test_learning_does_not_depend_on_partitions(spark):
    documents = spark.createDataFrame(
        [(i, ("plain words of a text " * (i % 5 + 1)) + str(i) if i % 3 else f"BAD!! $$$ {i} " * (i % 4 + 1)) for i in range(120)],
        DOCUMENTS,
    )
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], LABELS)
    found = []
    for parts in (1, 7):
        table = quality.describe(documents.repartition(parts))
        found.append(sorted(quality.score(table, quality.learn(table, labels, lambda key: F.lit(True))).collect()))
    assert found[0] == found[1]
    assert all((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in found[0])


def test_labels_missing_repeated_and_of_one_class(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, None), (2, ""), (None, "x"), (3, "y")], DOCUMENTS)
    table = quality.describe(documents.selectExpr("*", "1 AS statistics", "2 AS good", "3 AS fold"))

    def scores(labels):
        model = quality.learn(table, spark.createDataFrame(labels, LABELS), lambda key: F.lit(True))
        return [r.score for r in quality.score(table, model).collect()]

    assert scores([]) == [0.5] * 5
    assert scores([(1, 1), (3, 1)]) == [1.0] * 5
    assert scores([(1, None), (3, 0)]) == [0.0] * 5
    assert scores([(1, 1), (1, 0)]) == [0.0] * 5  # one label says poor
    both = scores([(1, 1), (3, 0), (None, 1)])
    assert all(np.isfinite(both)) and both[1] == both[2]
    empty = quality.describe(documents.limit(0))
    assert quality.score(empty, quality.learn(empty, spark.createDataFrame([], LABELS), lambda k: F.lit(True))).count() == 0

"""Quality by a regularised quadratic discriminant.

Every text is described by statistics of its whole length: sizes, shares of kinds
of characters, repetition of words, word triples and lines, entropy.  Each is
transformed towards a bell shape (logarithms of sizes and shares) and kept as a
whole number of 1/1024, so that sums over any number of texts are exact and do
not depend on their order.

Each class has a mean and a covariance.  Covariances are shrunk twice: towards
the one pooled over the classes, and then towards a multiple of the identity, in
units of the pooled standard deviations.  Both amounts come from a grid by the
log loss of labelled texts left out of the fit, fold by fold, over all labelled
training texts.  The score is the logistic of the difference of the classes'
Mahalanobis log densities plus the log of their prior odds; the inverse Cholesky
factors and log determinants are computed once per model.

On Spark the statistics are computed in one pass over the texts and stored;
labels meet these small rows, not the texts.  Per class and fold one row per
moment comes back.

Defined results: a null text is an empty one, whose statistics are all those of
nothing; a row labelled more than once is good only if all its labels say so; a
null label is none; without labels of both classes every text has the share of
good labels as score (a half when none is labelled); repeated rows are judged
alike and each counts when learning; columns other than those named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, product
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arealytics.llm.common import through_arrow
from arealytics.operators.joins import lookup_join
from arealytics.session import pin

UNIT = 1024  # a statistic is a whole number of these
SMALL = 0.01  # added to shares before the logarithm
FOLDS = 4
TO_POOLED = (0.0, 0.1, 0.3, 0.6, 1.0)
TO_IDENTITY = (0.01, 0.05, 0.2, 0.5)
LOSS_UNIT = 1_000_000
WORST = 30.0  # of one text's log loss
GOOD_FROM = 0.7

STATISTICS = (
    "words", "word length", "word length spread", "longest word", "upper case", "digits",
    "punctuation", "symbols", "exclamations", "beyond ascii", "marked word ends",
    "different words", "commonest word", "same word again", "different triples",
    "different lines", "words a line", "byte entropy",
)
SIZE = len(STATISTICS)


def _kinds() -> np.ndarray:
    """Byte -> kind, one column each: letters, upper, digits, usual marks, other
    ASCII marks, exclamation marks, bytes beyond ASCII, white space."""
    kinds = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        space = b == 32 or 9 <= b <= 13
        kinds[b] = [
            b < 128 and c.isalpha(), b < 128 and c.isupper(), b < 128 and c.isdigit(),
            c in ".,;:?'\"()-", b < 128 and 32 < b and not c.isalnum() and c not in ".,;:?!'\"()-",
            c == "!", b >= 128, space,
        ]
    return kinds


_KINDS = _kinds()
_SPACE = _KINDS[:, 7].astype(bool)
_IN_WORD = (_KINDS[:, 0] + _KINDS[:, 2] + _KINDS[:, 6]).astype(bool)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one whole text, in units of 1 / UNIT."""
    raw = (text or "").encode("utf-8", "replace")
    data = np.frombuffer(raw, np.uint8)
    counts = np.bincount(data, minlength=256)
    letters, upper, digits, usual, other, calls, beyond, _ = counts @ _KINDS
    size = max(1, len(data))
    words = raw.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    marked = 0
    if len(data):
        ends = np.append(_SPACE[data[1:]], True) & ~_SPACE[data]
        marked = int((ends & ~_IN_WORD[data]).sum())
    counted = Counter(words)
    triples = max(0, len(words) - 2)
    lines = raw.split(b"\n")
    shares = counts[counts > 0] / size
    values = [
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        _share(upper, letters),
        _share(digits, size),
        _share(usual, size),
        _share(other, size),
        _share(calls, size),
        _share(beyond, size),
        _share(marked, n),
        _share(len(counted), n),
        _share(max(counted.values(), default=0), n),
        _share(sum(map(eq, words, islice(words, 1, None))), n),
        _share(len(set(zip(words, islice(words, 1, None), islice(words, 2, None)))), max(1, triples)),
        _share(len(set(lines)), len(lines)),
        np.log1p(len(words) / len(lines)),
        -float(shares @ np.log2(shares)),
    ]
    return np.rint(np.array(values) * UNIT).astype(np.int32)


def _share(part: float, whole: float) -> float:
    return float(np.log(part / max(1.0, whole) + SMALL))


def describe(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, statistics) of every row, from one pass over the texts."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            found = [statistics(t).tobytes() for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "statistics": found}

    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    return through_arrow(rows, batches, "doc_id long, statistics binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, SIZE).astype(np.int64)


# ---- model -----------------------------------------------------------------------


@dataclass
class Moments:
    """Exact sums of one class."""

    count: int
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(
            self.count + other.count, self.sums + other.sums, self.products + other.products
        )

    def mean(self) -> np.ndarray:
        return self.sums / self.count

    def covariance(self) -> np.ndarray:
        mean = self.mean()
        return self.products / self.count - np.outer(mean, mean)


class Discriminant:
    """Two Gaussian classes with cached inverse Cholesky factors."""

    def __init__(self, classes: list[Moments], to_pooled: float, to_identity: float):
        self.flat = None
        self.to_pooled, self.to_identity = to_pooled, to_identity
        total = sum(c.count for c in classes)
        if not all(c.count for c in classes):
            self.flat = classes[1].count / total if total else 0.5
            return
        within = [c.covariance() for c in classes]
        pooled = sum(c.count * w for c, w in zip(classes, within)) / total
        # a unit of the grid at least, so that a constant statistic has a scale
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1.0))
        both = np.outer(self.scale, self.scale)
        pooled = pooled / both
        self.means, self.factors, self.offsets = [], [], []
        for c, w in zip(classes, within):
            mixed = (1 - to_pooled) * w / both + to_pooled * pooled
            level = max(np.trace(mixed) / SIZE, 1e-6)
            shrunk = (1 - to_identity) * mixed + to_identity * level * np.eye(SIZE)
            factor = np.linalg.cholesky(shrunk)
            self.means.append(c.mean())
            self.factors.append(np.linalg.inv(factor).T)
            self.offsets.append(-np.log(np.diag(factor)).sum() + np.log(c.count / total))

    def log_odds(self, statistics: np.ndarray) -> np.ndarray:
        """Of good against poor, per row."""
        if self.flat is not None:
            share = min(max(self.flat, 1e-12), 1 - 1e-12)
            return np.full(len(statistics), np.log(share / (1 - share)))
        sides = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            apart = (statistics - mean) / self.scale @ factor
            sides.append(offset - 0.5 * np.einsum("ij,ij->i", apart, apart))
        return sides[1] - sides[0]

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(statistics), float(self.flat))
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(statistics), -700, 700)))


_UPPER = np.triu_indices(SIZE)


def _moments(labelled: DataFrame) -> dict[tuple[int, int], Moments]:
    """Sums by (class, fold); a bounded number of rows comes back."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in arriving:
            good, fold = (batch.column(i).to_numpy() for i in (0, 1))
            rows = _matrix(batch.column(2))
            for key in set(zip(good.tolist(), fold.tolist())):
                some = rows[(good == key[0]) & (fold == key[1])]
                found = np.concatenate([[len(some)], some.sum(axis=0), (some.T @ some)[_UPPER]])
                sums[key] = sums.get(key, 0) + found
        for (good, fold), values in sums.items():
            size = len(values)
            yield {
                "good": [good] * size, "fold": [fold] * size,
                "moment": np.arange(size, dtype=np.int32), "value": values,
            }

    found = (
        through_arrow(labelled, batches, "good int, fold int, moment int, value long")
        .groupBy("good", "fold", "moment")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        .collect()
    )
    width = 1 + SIZE + len(_UPPER[0])
    values = {key: [0] * width for key in product((0, 1), range(FOLDS))}
    for row in found:
        values[row["good"], row["fold"]][row["moment"]] = int(row["value"])
    return {key: _as_moments(v) for key, v in values.items()}


def _as_moments(values: list[int]) -> Moments:
    numbers = np.array(values, np.float64)
    products = np.zeros((SIZE, SIZE))
    products[_UPPER] = numbers[1 + SIZE :]
    products = products + np.triu(products, 1).T
    return Moments(values[0], numbers[1 : 1 + SIZE], products)


def _losses(labelled: DataFrame, models: dict[tuple[int, int], Discriminant]) -> dict[int, int]:
    """Log loss of texts left out, by place in the grid."""
    shared = labelled.sparkSession.sparkContext.broadcast(models)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[int, int] = {}
        for batch in arriving:
            good, fold = (batch.column(i).to_numpy() for i in (0, 1))
            rows = _matrix(batch.column(2))
            for (place, left_out), model in shared.value.items():
                some = fold == left_out
                odds = model.log_odds(rows[some])
                loss = np.logaddexp(0, np.where(good[some] == 1, -odds, odds))
                whole = np.rint(np.minimum(loss, WORST) * LOSS_UNIT).astype(np.int64).sum()
                sums[place] = sums.get(place, 0) + int(whole)
        yield {"place": list(sums), "loss": list(sums.values())}

    found = (
        through_arrow(labelled, batches, "place int, loss long")
        .groupBy("place").agg(F.sum(F.col("loss").cast("decimal(38,0)")).alias("loss")).collect()
    )
    return {row["place"]: int(row["loss"]) for row in found}


def learn(
    described: DataFrame,
    labels: DataFrame,
    trains,
    *,
    id_column: str = "doc_id",
    label_column: str = "quality",
) -> Discriminant:
    """The model of rows (doc_id, statistics) whose id ``trains`` admits."""
    known = (
        labels.where(labels[label_column].isNotNull() & labels[id_column].isNotNull())
        .groupBy(labels[id_column].cast("long").alias("doc_id"))
        .agg((F.min(labels[label_column]) >= 1).cast("int").alias("good"))
        .where(trains("doc_id"))
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int"))
    )
    labelled = pin(
        lookup_join(described, pin(known), ["doc_id"], "inner").select("good", "fold", "statistics")
    )
    moments = _moments(labelled)

    def fitted(left_out: int | None, *amounts: float) -> Discriminant:
        nothing = Moments(0, np.zeros(SIZE), np.zeros((SIZE, SIZE)))
        classes = [
            sum((m for (g, fold), m in moments.items() if g == good and fold != left_out), nothing)
            for good in (0, 1)
        ]
        return Discriminant(classes, *amounts)

    grid = list(product(TO_POOLED, TO_IDENTITY))
    models = {
        (place, fold): fitted(fold, *amounts)
        for place, amounts in enumerate(grid) for fold in range(FOLDS)
    }
    losses = _losses(labelled, models)
    best = min(range(len(grid)), key=lambda place: (losses.get(place, 0), place))
    return fitted(None, *grid[best])


def score(described: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of every row (doc_id, statistics)."""
    shared = described.sparkSession.sparkContext.broadcast(model)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            yield {"doc_id": batch.column(0), "score": shared.value.scores(_matrix(batch.column(1)))}

    return through_arrow(described.select("doc_id", "statistics"), batches, "doc_id long, score double")

"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positive sample, all training texts, whatever
their label, the unlabelled one; the share of toxic rows among labelled rows is
the class prior.  Features are hashed words that are significantly more
frequent among positive texts, also against what the prior leaves for the rest.  Several linear classifiers, each on its own part
of the sample, minimise the class-prior-corrected risk

    prior * loss(positive, 1) + max(0, loss(unlabelled, 0) - prior * loss(positive, 0))

and, while the second part is below zero, step back on it.  A score is the
logistic of the mean of their outputs.

Defined results: a null or empty text has the score of a text without features;
without a confirmed toxic text, or without features that tell, every text has
the prior as score (0 when no row is labelled); a row labelled more than once
counts as toxic if any label says so; repeated rows are judged alike; columns
other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arealytics.llm.byte_grams import chunks, whole_words
from arealytics.llm.common import through_arrow
from arealytics.session import pin

BITS = 22
POSITIVE_SAMPLE = 4000  # confirmed toxic texts learned from, about
UNLABELLED_SAMPLE = 12000  # training texts learned from, about
FEATURES = 8192
MIN_Z = 5.0
MIN_RATIO = 4.0  # of the rates among toxic and other texts
CLASSIFIERS = 3
PART = 0.8  # of the sample that one classifier sees
STEPS = 400
RATE = 0.1
DECAY = 1e-6
SAMPLE_TASKS = 8
TOXIC_FROM = 0.7


class Classifier:
    """One weight per bin, nought for bins that are no feature."""

    def __init__(self, weights: np.ndarray, features: np.ndarray, bias: float):
        self.weights, self.features, self.bias = weights, features, bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        rows, bins = feature_pairs(texts, self.features)
        sums = np.bincount(rows, self.weights[bins], len(texts)) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(sums, -500, 500)))


def feature_pairs(texts: list[bytes], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bin) of words that are features."""
    rows, bins = whole_words(texts, BITS)
    told = features[bins]
    keys = np.unique((rows[told] << BITS) | bins[told])
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _sample(documents, labels, trains, id_column, text_column, label_column):
    """(positive, unlabelled, text) rows and the class prior."""
    known = (
        labels.where(labels[label_column].isNotNull() & labels[id_column].isNotNull())
        .groupBy(labels[id_column].alias("doc_id"))
        .agg(F.max(labels[label_column]).alias("toxic"))
        .where(trains("doc_id"))
    )
    labelled, toxic = known.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("toxic") == 1, 1))
    ).first()
    if not toxic:
        return None, 0.0
    ids = documents.select(documents[id_column].alias("doc_id")).where(trains("doc_id"))
    total = ids.count()

    def drawn(count: int, wanted: int, salt: int) -> Column:
        draw = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
        return draw < min(1.0, wanted / max(1, count))

    positive = known.where((F.col("toxic") == 1) & drawn(toxic, POSITIVE_SAMPLE, 1)).select(
        "doc_id", F.lit(True).alias("positive")
    )
    rows = documents.select(
        documents[id_column].alias("doc_id"), documents[text_column].cast("string").alias("text")
    ).where(trains("doc_id"))
    # the sample of ids is bounded by its parameter
    marked = rows.join(F.broadcast(positive), "doc_id", "left").select(
        F.coalesce("positive", F.lit(False)).alias("positive"),
        F.coalesce(drawn(total, UNLABELLED_SAMPLE, 2), F.lit(True)).alias("unlabelled"),
        F.xxhash64("doc_id", F.lit(9)).alias("draw"),
        "text",
    )
    sample = marked.where("(positive OR unlabelled) AND text IS NOT NULL").repartition(SAMPLE_TASKS)
    return pin(sample), min(0.9, max(1e-4, toxic / labelled))


def _select(sample: DataFrame, prior: float) -> np.ndarray:
    """Bins that positive texts have significantly more often."""

    def count(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found = np.zeros((2, 1 << BITS), np.int32)
        for batch in arriving:
            sides = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for first, texts in chunks(batch.column(3).to_pylist()):
                rows, bins = whole_words(texts, BITS)
                keys = np.unique((rows << BITS) | bins)
                rows, bins = keys >> BITS, keys & ((1 << BITS) - 1)
                for side, marks in enumerate(sides):
                    there = marks[first : first + len(texts)]
                    np.add.at(found[side], bins[there[rows]], 1)
        some = np.flatnonzero(found.any(axis=0))
        yield {"bin": some, "p": found[0][some], "u": found[1][some]}

    counted = through_arrow(sample, count, "bin long, p int, u int").groupBy("bin").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")
    )
    # no more rows than bins, and those of the positive sample only
    table = counted.where("p > 0").toArrow()
    n_p, n_u = (
        max(1, n)
        for n in sample.agg(F.count(F.when(F.col("positive"), 1)), F.count(F.when(F.col("unlabelled"), 1))).first()
    )
    bins, in_p, in_u = (table[c].to_numpy().astype(np.float64) for c in ("bin", "p", "u"))
    rate_p, rate_u = in_p / n_p, in_u / n_u
    both = np.clip((in_p + in_u) / (n_p + n_u), 1e-12, 1 - 1e-12)
    z = (rate_p - rate_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    rate_n = np.maximum(0.0, (rate_u - prior * rate_p) / (1 - prior))
    good = np.flatnonzero((z > MIN_Z) & (rate_p > MIN_RATIO * rate_n))
    best = good[np.lexsort((bins[good], -z[good]))][:FEATURES]
    return np.sort(bins[best].astype(np.int64))


def fit_nnpu(
    rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray,
    width: int, prior: float,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole sparse sample at once."""
    count = len(positive)
    weights, bias = np.zeros(width + 1), np.log(prior / (1 - prior))
    weights[-1] = bias
    moment, square = np.zeros(width + 1), np.zeros(width + 1)
    p = positive / max(1, positive.sum())
    u = unlabelled / max(1, unlabelled.sum())
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights[columns], count) + weights[-1]
        sigmoid = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))
        up = np.logaddexp(0, z)  # loss as a negative
        rest = float(u @ up - prior * (p @ up))
        of_rest = u * sigmoid - prior * p * sigmoid
        if rest >= 0:
            slope = -prior * p * (1 - sigmoid) + of_rest
        else:
            slope = -of_rest
        gradient = np.append(np.bincount(columns, slope[rows], width), slope.sum())
        gradient[:-1] += DECAY * weights[:-1]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def learn(
    documents: DataFrame,
    labels: DataFrame,
    trains,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Classifier:
    """Train on rows whose id ``trains(column name)`` admits."""
    nothing = np.zeros(1 << BITS, bool)
    sample, prior = _sample(documents, labels, trains, id_column, text_column, label_column)
    if sample is None:
        return Classifier(np.zeros(1 << BITS, np.float32), nothing, -500.0)
    chosen = _select(sample, prior)
    flat = Classifier(np.zeros(1 << BITS, np.float32), nothing, float(np.log(prior / (1 - prior))))
    if not len(chosen):
        return flat
    told = nothing.copy()
    told[chosen] = True

    def features(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            for first, texts in chunks(batch.column(3).to_pylist()):
                rows, bins = feature_pairs(texts, told)
                cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
                some = batch.slice(first, len(texts))
                found = np.searchsorted(chosen, bins).astype(np.int32)
                yield {
                    "positive": some.column(0), "unlabelled": some.column(1),
                    "draw": some.column(2),
                    "features": [found[a:b] for a, b in zip(cuts, cuts[1:])],
                }

    rows = through_arrow(
        sample, features, "positive boolean, unlabelled boolean, draw long, features array<int>"
    )
    members = rows.withColumn("member", F.explode(F.sequence(F.lit(1), F.lit(CLASSIFIERS)))).where(
        F.pmod(F.xxhash64("draw", "member"), F.lit(1000)) < int(1000 * PART)
    )

    def train(part: pd.DataFrame) -> pd.DataFrame:
        # a fixed order of rows, so that sums of doubles repeat
        part = part.sort_values("draw", kind="stable")
        sizes = [len(x) for x in part["features"]]
        at = np.repeat(np.arange(len(part)), sizes)
        columns = np.concatenate([np.asarray(x, np.int64) for x in part["features"]])
        weights, bias = fit_nnpu(
            at, columns, part["positive"].to_numpy(float), part["unlabelled"].to_numpy(float),
            len(chosen), prior,
        )
        return pd.DataFrame({"weights": [weights], "bias": [bias]})

    # a bounded sample per classifier; CLASSIFIERS rows come back
    trained = members.groupBy("member").applyInPandas(train, "weights array<double>, bias double").collect()
    weights = np.zeros(1 << BITS, np.float32)
    weights[chosen] = np.mean([t["weights"] for t in trained], axis=0)
    return Classifier(weights, told, float(np.mean([t["bias"] for t in trained])))


def score(
    documents: DataFrame, model: Classifier, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and score of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # one weight per bin

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        for batch in arriving:
            found = [model.scores(t) for _, t in chunks(batch.column(1).to_pylist())]
            if found:
                yield {"doc_id": batch.column(0), "score": np.concatenate(found)}

    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    return through_arrow(rows, batches, "doc_id long, score double")


def without_toxic(
    documents: DataFrame, model: Classifier, *, text_column: str = "text",
    toxic_from: float = TOXIC_FROM,
) -> DataFrame:
    """The documents that score below ``toxic_from``; all columns are kept."""
    fields = [f.name for f in documents.schema.fields]
    packed = documents.select(F.struct(*[documents[f] for f in fields]).alias("row"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = fields.index(text_column)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        for batch in arriving:
            found = [model.scores(t) for _, t in chunks(batch.column(0).field(at).to_pylist())]
            if found:
                clean = np.concatenate(found) < toxic_from
                yield {"row": batch.column(0).filter(pa.array(clean))}

    return through_arrow(packed, batches, packed.schema).select("row.*")

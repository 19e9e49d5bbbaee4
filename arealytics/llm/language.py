"""Language identification by mixtures of n-gram models.

Every language has a distribution of hashed byte n-grams, learned from a bounded
sample of its labelled texts.  A text is a mixture of languages: expectation
maximisation finds the proportions, and the set of languages is the one with
the largest likelihood after a penalty for each language more.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when no labelled text could be learned from; equal
likelihoods go to the language first in order; repeated rows are judged alike;
columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arealytics.llm.byte_grams import chunks, grams
from arealytics.llm.common import through_arrow

NGRAM = 3
BITS = 16
SAMPLE_PER_LANGUAGE = 3000  # labelled texts learned from, about
SMOOTHING = 0.5
ROUNDS = 12  # for all languages at once
SET_ROUNDS = 40  # for a chosen set
PENALTY = 6.0  # times the logarithm of the n-grams, for each language more
OVERLAP = 3.0  # neighbouring n-grams share bytes; evidence counts once
MIN_SHARE = 0.3
UNKNOWN = "und"


class Mixture:
    """Distributions of all languages over the bins."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0, keepdims=True) + SMOOTHING * len(counts)
        self.probabilities = ((counts + SMOOTHING) / total).astype(np.float32)

    def judge(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, proportions) of each text."""
        rows, bins = grams(texts, NGRAM, BITS)
        keys, counts = np.unique((rows << BITS) | bins, return_counts=True)
        rows, bins = keys >> BITS, keys & ((1 << BITS) - 1)
        counts = counts.astype(np.float64)
        size = np.bincount(rows, counts, len(texts))
        kinds = len(self.languages)
        share = np.full((len(texts), kinds), 1.0 / kinds)
        score = np.zeros(len(texts))
        here = np.flatnonzero(size)
        if len(here):
            starts = np.searchsorted(rows, here)
            dense = np.searchsorted(here, rows)  # texts that have n-grams
            model = self.probabilities[bins]
            alone = np.add.reduceat(np.log(model) * counts[:, None], starts, axis=0)
            one = alone.max(axis=1)
            chosen = np.zeros((len(here), kinds))
            chosen[np.arange(len(here)), alone.argmax(axis=1)] = 1.0
            if kinds > 1:
                self._widen(chosen, model, counts, dense, one, size[here])
            relative = np.exp(np.maximum((alone - one[:, None]) / OVERLAP, -700.0))
            certain = relative / relative.sum(axis=1, keepdims=True)
            main = chosen.argmax(axis=1)
            at = np.arange(len(here))
            share[here] = chosen
            # languages of a mixture don't compete with one another
            score[here] = chosen[at, main] * np.where(chosen > 0, certain, 0).sum(axis=1)
        best = share.argmax(axis=1)
        return [self.languages[i] for i in best], np.clip(score, 0.0, 1.0), share

    def _widen(self, chosen, model, counts, dense, one, size) -> None:
        """Replace single languages by the set of largest penalised likelihood.
        The likelihood of all languages together bounds that of every set; it is
        concave, so its slope bounds what further rounds could add.  Only texts
        where that bound beats the penalty are looked at again."""
        penalty = PENALTY * np.log(size + 1.0)
        everything, full, more = _fit(model, counts, dense, np.ones_like(chosen), ROUNDS)
        full = full + more
        mixed = np.flatnonzero(full - one > penalty)
        if not len(mixed):
            return
        order = np.argsort(-everything, axis=1, kind="stable")
        best = one.copy()
        for kinds in range(2, chosen.shape[1] + 1):
            pick = np.isin(dense, mixed)
            if not pick.any():
                return
            allowed = np.zeros((len(mixed), chosen.shape[1]))
            np.put_along_axis(allowed, order[mixed, :kinds], 1.0, axis=1)
            share, fit, _ = _fit(
                model[pick], counts[pick], np.searchsorted(mixed, dense[pick]), allowed,
                SET_ROUNDS,
            )
            value = fit - penalty[mixed] * (kinds - 1)
            better = value > best[mixed]
            best[mixed[better]] = value[better]
            chosen[mixed[better]] = share[better]
            mixed = mixed[better | (full[mixed] - penalty[mixed] * kinds > best[mixed])]


def _fit(model, counts, rows, allowed, rounds: int):
    """Proportions among the allowed languages, the log-likelihood, and a bound
    on what is missing to its maximum."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    starts = np.searchsorted(rows, np.arange(len(allowed)))
    size = np.add.reduceat(counts, starts)[:, None]
    for _ in range(rounds):
        part = model * share[rows]
        part *= (counts / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / size
    mixed = (model * share[rows]).sum(axis=1)
    slope = np.add.reduceat(model * (counts / mixed)[:, None], starts, axis=0) - size
    missing = np.maximum(0.0, np.where(allowed > 0, slope, -np.inf).max(axis=1))
    return share, np.add.reduceat(np.log(mixed) * counts, starts), missing


def learn(
    documents: DataFrame,
    trains: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE,
) -> Mixture | None:
    """A mixture from rows where ``trains`` holds and the language is given.
    About ``sample`` texts of each language are read; which ones is decided by
    a hash of the id."""
    language = documents[language_column].cast("string")
    labelled = documents.where(trains & language.isNotNull() & documents[text_column].isNotNull())
    # one row per language
    known = {
        r["l"]: r["n"]
        for r in labelled.groupBy(language.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not known:
        return None
    languages = sorted(known)
    draw = F.pmod(F.xxhash64(F.col(id_column), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    chance = F.create_map(
        *[x for l in languages for x in (F.lit(l), F.lit(min(1.0, sample / known[l])))]
    )
    picked = labelled.where(draw < F.element_at(chance, language)).select(
        language.alias("lang"), documents[text_column].cast("string").alias("text")
    )
    place = {l: i for i, l in enumerate(languages)}

    def count(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found = np.zeros((len(languages) << BITS), np.int64)
        for batch in arriving:
            kinds = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, texts in chunks(batch.column(1).to_pylist()):
                rows, bins = grams(texts, NGRAM, BITS)
                found += np.bincount((kinds[first + rows] << BITS) | bins, minlength=len(found))
        some = np.flatnonzero(found)
        yield {"bin": some, "n": found[some]}

    sums = through_arrow(picked, count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    # at most languages times bins rows
    table = sums.toArrow()
    counts = np.zeros(len(languages) << BITS)
    counts[table["bin"].to_numpy()] = table["n"].to_numpy()
    return Mixture(languages, counts.reshape(len(languages), -1).T)


def identify(
    documents: DataFrame,
    model: Mixture | None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, lang_pred, score and the proportions found, for every row."""
    text = documents[text_column].cast("string")
    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    schema = "doc_id long, lang_pred string, score double, shares map<string,double>"
    if model is None:
        return rows.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.create_map().cast("map<string,double>").alias("shares"),
        )
    shared = rows.sparkSession.sparkContext.broadcast(model)  # languages times bins

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        for batch in arriving:
            names: list[str] = []
            scores, shares = [], []
            for _, texts in chunks(batch.column(1).to_pylist()):
                found, score, share = model.judge(texts)
                names += found
                scores.append(score)
                shares.append(share)
            if not names:
                continue
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            score = np.where(letters, np.concatenate(scores), 0.0)
            yield {
                "doc_id": batch.column(0),
                "lang_pred": [n if l else UNKNOWN for n, l in zip(names, letters)],
                "score": score,
                "shares": [
                    [(model.languages[i], float(s[i])) for i in np.flatnonzero(s)] if l else []
                    for s, l in zip(np.concatenate(shares), letters)
                ],
            }

    return through_arrow(rows, batches, schema)


def in_known_language(
    documents: DataFrame, model: Mixture | None, *, id_column: str = "doc_id",
    text_column: str = "text", min_share: float = MIN_SHARE,
) -> DataFrame:
    """The documents whose main language is known and has at least
    ``min_share``; all columns are kept.  Without a model, that is without a
    labelled text to learn from, no language is rejected and all documents with
    a letter stay."""
    fields = [f.name for f in documents.schema.fields]
    packed = documents.select(F.struct(*[documents[f] for f in fields]).alias("row"))
    if model is None:
        text = documents[text_column].cast("string")
        return documents.where(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = fields.index(text_column)
    letters = F.coalesce(F.col(f"row.`{text_column}`").cast("string").rlike(r"\p{L}"), F.lit(False))
    candidates = packed.where(letters)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        for batch in arriving:
            scores = [
                model.judge(texts)[1]
                for _, texts in chunks(batch.column(0).field(at).to_pylist())
            ]
            if scores:
                keep = np.concatenate(scores) >= min_share
                yield {"row": batch.column(0).filter(pa.array(keep))}

    return through_arrow(candidates, batches, packed.schema).select("row.*")

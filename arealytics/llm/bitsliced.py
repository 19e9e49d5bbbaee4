"""Ranked lexical search on bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its (term, level) pairs: level 0 of
every term, level l of terms that occur at least 2 ** l times.  Documents of
like size stand in blocks, and a block is stored by slices: one bitmap over its
documents per signature position.  The bits of a term are the AND of its slices;
a document without them does not hold the term (or not as often), so the slices
overestimate every term frequency, by less than a factor of two.  Weighting the
bits of an item's terms and adding them up gives an upper bound of the score of
every document of the block at once.

The k documents with the largest bounds are scored exactly; the k-th of these
scores is a floor for the answer.  Then every document whose bound reaches the
floor is scored exactly, so only documents that provably do not belong to the
answer are left out, and the result is that of scoring all of them.

On Spark, signatures are built and scanned by partition; only bounds, floors and
candidates travel.  Items are searched in blocks of ITEMS; their terms, floors
and weights are broadcast and bounded by that number.  An index is written once
and read by every block of items.

Defined results: a null text has no terms; a document or item without terms is
in no answer; rows that share an id are separate documents, ranked one after the
other; a null id comes last among equal scores; items that share an id are
searched separately; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arealytics.llm.common import ODD, WordHashes, mix, through_arrow
from arealytics.operators.joins import lookup_join
from arealytics.session import pin

K = 20
ITEMS = 1000  # searched at once
BITS = 12  # of a signature for each of its entries
HASHES = 4
BLOCK_DOCUMENTS = 1024
BLOCK_BITS = 1 << 22
SUM_CELLS = 1 << 21  # of the table of weighted bits held at once

#: Fixed values of the ranking: terms are runs of ASCII letters, digits and
#: characters beyond ASCII, A-Z lower-cased.
_TERM_BYTES = bytes(
    b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256)
)
SCALE = 1_000_000_000
_NO_ID = np.iinfo(np.int64).max  # after all ids


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split() if text else []


def length_factor(n, documents: int, tokens: int):
    """m: 100 for a document of mean length."""
    return 100 - 25 + (25 * n * documents) // max(1, tokens)


def gain(tf, m):
    return (SCALE * tf) // (1000 * tf + 12 * m)


# ---- signatures ------------------------------------------------------------


def positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The HASHES signature positions of terms on a level."""
    with np.errstate(over="ignore"):
        value = mix(hashes + np.uint64(level) * ODD)
        first, step = value & np.uint64(0xFFFFFFFF), value >> np.uint64(32) | np.uint64(1)
        steps = np.arange(HASHES, dtype=np.uint64)
        return ((first[:, None] + steps * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def signature_bits(entries: int) -> int:
    return max(256, 1 << int(BITS * entries - 1).bit_length()) if entries else 256


@dataclass
class _Block:
    """Documents of one signature size, waiting to be sliced."""

    bits: int
    ids: list = field(default_factory=list)
    hashes: list = field(default_factory=list)  # of the terms of a document
    tf: list = field(default_factory=list)

    def full(self) -> bool:
        return len(self.ids) >= max(1, min(BLOCK_DOCUMENTS, BLOCK_BITS // self.bits))

    def sliced(self) -> dict:
        """One packed row; a slice is a run of bytes of equal length."""
        width = -(-len(self.ids) // 8) * 8
        cells = np.zeros(self.bits * width, np.uint8)
        sizes = [len(tf) for tf in self.tf]
        hashes, tf = np.concatenate(self.hashes), np.concatenate(self.tf)
        row = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.cumsum([0, *sizes[:-1]])
        n, most = np.add.reduceat(tf, starts), np.maximum.reduceat(tf, starts)
        for level in range(int(most.max()).bit_length()):
            some = tf >= 1 << level
            hashes, tf, row = hashes[some], tf[some], row[some]
            cells[positions(hashes, level, self.bits) * width + row[:, None]] = 1
        return {
            "bits": [self.bits], "ids": [self.ids], "n": [n.tobytes()], "most": [most.tobytes()],
            "slices": [np.packbits(cells).tobytes()],
            "documents": [len(self.ids)], "tokens": [int(n.sum())], "df": [None],
        }


_INDEX = (
    "bits int, ids array<long>, n binary, most binary, slices binary, "
    "documents long, tokens long, df binary"
)


def _scan(rows: DataFrame, vocabulary: list[bytes], sign: bool) -> DataFrame:
    """Sliced blocks of all documents with a term (if ``sign``), and per task one
    row that counts the documents holding each term of the vocabulary."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = {t: i for i, t in enumerate(shared.value)}
        asked = place.keys()
        df = np.zeros(len(place), np.int64)
        hashes = WordHashes()
        blocks: dict[int, _Block] = {}
        for batch in arriving:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = Counter(terms(text))
                if not counts:
                    continue
                df[[place[t] for t in counts.keys() & asked]] += 1
                if not sign:
                    continue
                bits = signature_bits(sum(map(int.bit_length, counts.values())))
                block = blocks.get(bits) or blocks.setdefault(bits, _Block(bits))
                block.ids.append(doc_id)
                block.hashes.append(hashes.of(list(counts)))
                block.tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
                if block.full():
                    yield blocks.pop(block.bits).sliced()
        for block in blocks.values():
            yield block.sliced()
        yield {
            "bits": [0], "ids": [None], "n": [None], "most": [None], "slices": [None],
            "documents": [0], "tokens": [0], "df": [df.tobytes()],
        }

    return through_arrow(rows, batches, _INDEX)


def _document_counts(scanned: DataFrame, size: int) -> np.ndarray:
    """Sums of the tasks' counts; one row per task is added up where it lies."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(size, np.int64)
        for batch in arriving:
            for counts in batch.column(0).to_pylist():
                total += np.frombuffer(counts, np.int64)
        some = np.flatnonzero(total)
        yield {"term": some, "df": total[some]}

    counted = (
        through_arrow(scanned.where("df IS NOT NULL").select("df"), batches, "term long, df long")
        .groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    )  # no more rows than the items have terms
    found = np.zeros(size, np.int64)
    found[counted["term"].to_numpy()] = counted["df"].to_numpy()
    return found


# ---- items ---------------------------------------------------------------------


@dataclass
class Items:
    """A block of items: entries (item, term, weight), by item."""

    ids: list
    vocabulary: list[bytes]
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None  # of entries, repeats included
    documents: int = 0
    tokens: int = 0
    floor: np.ndarray | None = None  # score of the k-th known document
    last: np.ndarray | None = None  # its id: an equal score counts up to here

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        counted = [Counter(terms(text)) for _, text in rows]
        vocabulary = sorted(set().union(*counted)) if counted else []
        place = {t: i for i, t in enumerate(vocabulary)}
        entries = [(i, place[t], n) for i, c in enumerate(counted) for t, n in c.items()]
        item, term, times = np.array(entries, np.int64).reshape(-1, 3).T
        return Items([i for i, _ in rows], vocabulary, item, term, times)

    def weigh(self, df: np.ndarray, documents: int, tokens: int) -> Items:
        """Entries that some document holds, with their weights."""
        ratio = (2 * documents + 2) / (2 * df + 1)
        weight = np.floor(1000 * np.log(ratio)).astype(np.int64)
        held = (df > 0)[self.term]
        item, term, times = self.item[held], self.term[held], self.times[held]
        return Items(
            self.ids, self.vocabulary, item, term, times, times * weight[term], documents, tokens,
            np.zeros(len(self.ids), np.int64), np.full(len(self.ids), _NO_ID),
        )


def _blocks_of(items: DataFrame, size: int) -> Iterator[Items]:
    held: list[tuple] = []
    for row in items.toLocalIterator():
        held.append((row[0], row[1]))
        if len(held) == size:
            yield Items.of(held)
            held = []
    if held:
        yield Items.of(held)


# ---- bounds ----------------------------------------------------------------------


class Bounds:
    """Upper bounds of the scores of a block's documents."""

    def __init__(self, items: Items):
        self.items = items
        self.used = np.unique(items.term)
        self.entry_term = np.searchsorted(self.used, items.term)
        hashes = WordHashes()
        self.hashes = hashes.of([items.vocabulary[t] for t in self.used])

    def of(self, row: dict) -> np.ndarray:
        """(items, documents) bounds."""
        items = self.items
        n = np.frombuffer(row["n"], np.int64)
        most = np.frombuffer(row["most"], np.int64)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1)
        m = length_factor(n, items.documents, items.tokens)
        bound = np.zeros((len(items.ids), len(n)), np.int64)
        rows = np.arange(len(self.used))
        present, before = None, 0
        for level in range(int(most.max()).bit_length()):
            at = positions(self.hashes[rows], level, row["bits"])
            held = np.bitwise_and.reduce(slices[at], axis=1)
            if present is not None:
                held &= present
            some = held.any(axis=1)
            rows, present = rows[some], held[some]
            if not len(rows):
                break
            upto = gain(np.minimum((2 << level) - 1, most), m)
            self._add(bound, rows, present, len(n), upto - before)
            before = upto
        return bound

    def _add(self, bound, rows, present, documents: int, more: np.ndarray) -> None:
        """Weights of the entries whose terms have their bit, times the gain."""
        place = np.full(len(self.used), -1)
        place[rows] = np.arange(len(rows))
        entries = np.flatnonzero(place[self.entry_term] >= 0)
        step = max(1, SUM_CELLS // documents)
        for start in range(0, len(entries), step):
            some = entries[start : start + step]
            bits = np.unpackbits(present[place[self.entry_term[some]]], axis=1, count=documents)
            cells = bits * self.items.weight[some, None]
            item = self.items.item[some]
            cuts = np.flatnonzero(np.diff(item, prepend=-1))
            bound[item[cuts]] += np.add.reduceat(cells, cuts, axis=0) * more


_BOUND = "item int, doc_id long, bound long"


def _largest_bounds(index: DataFrame, items: Items, k: int) -> DataFrame:
    """Per task the k documents of each item with the largest bounds."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bounds = Bounds(shared.value)
        size = len(shared.value.ids)
        best, whose = np.zeros((size, 0), np.int64), np.zeros((size, 0), object)
        for batch in arriving:
            for row in batch.to_pylist():
                found = bounds.of(row)
                ids = np.empty(found.shape[1], object)
                ids[:] = row["ids"]
                best = np.concatenate([best, found], axis=1)
                whose = np.concatenate([whose, np.broadcast_to(ids, found.shape)], axis=1)
                if best.shape[1] > k:
                    keep = np.argpartition(-best, k - 1, axis=1)[:, :k]
                    best = np.take_along_axis(best, keep, axis=1)
                    whose = np.take_along_axis(whose, keep, axis=1)
        item, column = np.nonzero(best)
        yield {
            "item": item.astype(np.int32),
            "doc_id": pa.array(whose[item, column].tolist(), pa.int64()),
            "bound": best[item, column],
        }

    return through_arrow(index, batches, _BOUND)


def _not_excluded(index: DataFrame, items: Items) -> DataFrame:
    """(item, doc_id) of all documents whose bound exceeds the item's floor, or
    equals it with an id up to that of the floor's document."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bounds = Bounds(shared.value)
        floor, last = shared.value.floor[:, None], shared.value.last[:, None]
        for batch in arriving:
            for row in batch.to_pylist():
                found = bounds.of(row)
                ids = pa.array(row["ids"], pa.int64())
                names = ids.fill_null(_NO_ID).to_numpy()
                reached = (found > floor) | ((found == floor) & (names <= last) & (found > 0))
                item, column = np.nonzero(reached)
                yield {
                    "item": item.astype(np.int32), "doc_id": ids.take(pa.array(column)),
                    "bound": found[item, column],
                }

    return through_arrow(index, batches, _BOUND)


# ---- exact scores ------------------------------------------------------------------


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("_key")


def _exact(rows: DataFrame, candidates: DataFrame, items: Items, k: int) -> DataFrame:
    """The k best of the candidate documents for each item, by task."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    asked = pin(
        candidates.groupBy(_key("doc_id")).agg(F.collect_set("item").alias("items"))
    )
    met = lookup_join(rows.withColumn("_key", _key("doc_id")), asked, ["_key"], "inner")

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        items = shared.value
        starts = np.searchsorted(items.item, np.arange(len(items.ids) + 1)).tolist()
        entries = [
            [(items.vocabulary[t], w) for t, w in zip(items.term[a:b].tolist(), items.weight[a:b].tolist())]
            for a, b in zip(starts, starts[1:])
        ]
        best: dict[int, list] = {}
        for batch in arriving:
            for doc_id, text, asking in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = terms(text)
                counts = Counter(words)
                m = length_factor(len(words), items.documents, items.tokens)
                # a heap's smallest is its worst; among equals a large or no id
                order = (0, 0) if doc_id is None else (1, -doc_id)
                for item in asking:
                    score = sum(w * gain(counts[t], m) for t, w in entries[item] if t in counts)
                    if score > 0:
                        heap = best.setdefault(item, [])
                        (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score, order))
        found = [(i, None if o == (0, 0) else -o[1], s) for i, heap in best.items() for s, o in heap]
        item, ids, scores = zip(*found) if found else ((), (), ())
        yield {
            "item": np.array(item, np.int32), "doc_id": pa.array(ids, pa.int64()),
            "score": np.array(scores, np.int64),
        }

    scored = through_arrow(met.select("doc_id", "text", "items"), batches, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = K,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    at_once: int = ITEMS,
) -> DataFrame:
    """The k documents with the highest scores above 0 for every item: item_id,
    rank, doc_id, score and candidates (documents scored for the item)."""
    spark = documents.sparkSession
    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    asked = items.select(
        items[item_column].cast("long").alias("item_id"), items[item_text_column].cast("string")
    )
    answer = spark.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long, candidates long"
    )
    index = None
    for block in _blocks_of(asked, at_once):
        scanned = pin(_scan(rows, block.vocabulary, index is None))
        if index is None:
            index = scanned.where("slices IS NOT NULL").select("bits", "ids", "n", "most", "slices")
            documents_held, tokens = scanned.agg(
                F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))
            ).first()
        block = block.weigh(_document_counts(scanned, len(block.vocabulary)), documents_held, tokens)
        answer = answer.unionByName(_search_block(rows, index, block, k))
    return answer


def _search_block(rows: DataFrame, index: DataFrame, items: Items, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
    likely = _largest_bounds(index, items, k).withColumn("rank", F.row_number().over(order))
    # at most k rows per item of the block come back
    floors = (
        _exact(rows, likely.where(F.col("rank") <= k), items, k).where(F.col("rank") == k)
        .select("item", "score", "doc_id").collect()
    )
    for item, score, doc_id in floors:
        items.floor[item] = score
        items.last[item] = _NO_ID if doc_id is None else doc_id
    candidates = pin(_not_excluded(index, items).select("item", "doc_id"))
    counted = candidates.groupBy("item").agg(F.count(F.lit(1)).alias("candidates"))
    names = rows.sparkSession.createDataFrame(
        list(enumerate(items.ids)), "item int, item_id long"
    ).join(counted, "item")
    found = _exact(rows, candidates, items, k)
    # as many rows as items in a block
    return found.join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "candidates"
    )


_TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

SEARCH_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, {_TERMS_SQL} AS terms FROM documents
), i AS (
  SELECT item_id, row_number() OVER () AS item, {_TERMS_SQL} AS terms FROM benchmark
), t AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL
), q AS (
  SELECT item, item_id, unnest(terms) AS term FROM i
), corpus AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM d
), w AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, corpus GROUP BY term, n
), lengths AS (
  SELECT row, doc_id, 100 - 25 + (25 * len(terms) * n) // l AS m FROM d, corpus WHERE len(terms) > 0
), scored AS (
  SELECT item, item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN lengths USING (row)
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

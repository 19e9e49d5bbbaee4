"""Hierarchical Pitman-Yor language model over words.

Restaurants stand in three levels.  Every word of the training texts has a
context restaurant for the words that follow it; all contexts whose words end
alike share a parent; all parents share the root, which draws from a uniform
base.  The number of restaurants grows with the words, at every size alike.

Seating is sampled by Gibbs sweeps.  For each dish of each restaurant the number
of its tables is redrawn given the rest: from its exact conditional up to
EXACT customers (generalised Stirling numbers), and beyond by seating the
further customers in small groups.  Within a sweep restaurants use the table
totals of the sweep before, as parallel samplers do.  Predictive probabilities
are averaged over the sweeps after the burn-in.

On Spark, (context, word) counts are dealt by word into buckets.  All of a
word's dishes lie in one bucket, those of a frequent word in one per parent, so
no word can fill a bucket by itself.  Which words count as frequent is read off
a bounded sample and decides the layout alone: the totals of frequent contexts
and of parents are a bounded number of rows, recorded per sweep and sent to all
buckets.  The totals of all other contexts are added up by context after each
sweep, dealt into shards, and go back to the buckets that draw from them; neither
side is broadcast.  So every restaurant is redrawn in each sweep, given its parent
and its totals after the sweep before.  Each seating is stored once, for the next
sweep, the totals and scoring; draws have seeds, so a lost executor changes nothing.

To score, the words of a block of texts are sent to the buckets, looked up there
and added per text.  A word after a context that the bucket has no dish of goes
on to the restaurants of that context with its parent's probabilities.

Defined results: A-Z is lower-cased; a text is its words and one end; a null
text is the end alone; a word never trained on has the root's share of one
unknown word, and after it the parent's probabilities hold; rows are scored one
by one, also repeated ones; without training texts every word has probability
1 / (number of known words + 1); columns other than the id and the text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache, lru_cache, reduce
from itertools import count as count_from, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from arealytics.llm.common import END_WORD, ODD, mix, through_arrow
from arealytics.session import pin

FREQUENT = 50_000  # words that fill one place in so many of the sample are spread
SAMPLE_BYTES = 32_000_000
CLASSES = 256  # parents; 0 stands for the beginning of a text
SWEEPS = 3
BURN_IN = 1
STRENGTH = 1.0
EXACT = 64
SMALL = 8
LEAP = 0.05  # share of a dish's customers that is seated at once beyond EXACT
CELLS = 400_000  # weights of table counts that are held at once
CHUNK_TOKENS = 400_000
CHUNK_TEXTS = 60_000  # places of texts in a chunk take 16 bits
BUCKET_BYTES = 2_500_000  # of training text, on average
SHARD_BYTES = 8_000_000
SCORED_TOKENS = 100_000  # of a bucket's requests that are scored at once
ROWS = 64  # packed rows that travel together
ROUNDS = 3  # parts of the texts that are scored one after the other
BEGIN = np.uint64(0)  # the context of a first word, of class 0
OTHER = 0xFFFF  # stands for a context that is not frequent


class _Places(dict):
    """word -> its place among the words of a chunk; the first two are the end
    and the beginning."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self) + 2
        return found

    def hashes(self) -> np.ndarray:
        """Of each place: the class by ending in the top byte, 56 bits of hash."""
        whole = np.fromiter(map(xxhash.xxh3_64_intdigest, self), np.uint64, len(self))
        sizes = np.fromiter(map(len, self), np.int64, len(self))
        letters = np.frombuffer(b"".join(self), np.uint8).astype(np.int64)
        last = np.cumsum(sizes) - 1
        ending = _endings()[np.where(sizes > 1, 256 + (letters[last - 1] << 8), 0) + letters[last]]
        named = ending << np.uint64(56) | whole >> np.uint64(8)
        return np.concatenate([[END_WORD, BEGIN], named]).astype(np.uint64)


@cache
def _endings() -> np.ndarray:
    """The class of each ending: of words of one byte, then of the last two."""
    two = (bytes([a, b]) for a in range(256) for b in range(256))
    hashed = [xxhash.xxh3_64_intdigest(w) for w in (*(bytes([b]) for b in range(256)), *two)]
    return np.array(hashed, np.uint64) % np.uint64(CLASSES - 1) + np.uint64(1)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _store(df: DataFrame) -> DataFrame:
    """``pin``, and give back the shuffle files of the way there at its end."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        return pin(df)
    finally:
        conf.set(CLEAN_UP, before)


def _drop(stored: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = stored.sparkSession
    for name in stored.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


@dataclass
class _Chunk:
    ids: list
    sizes: np.ndarray  # tokens per text
    tokens: np.ndarray  # places among words
    words: np.ndarray

    def before(self) -> np.ndarray:
        """The place of each token's context."""
        before = np.empty(len(self.tokens), np.int32)
        before[1:] = self.tokens[:-1]
        before[np.cumsum([0, *self.sizes[:-1]])] = 1
        return before


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words that ``lower_words`` gives, of all texts, and how many each has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = split.flatten()
    whole = pc.not_equal(pc.binary_length(words), 0)  # white space at either end leaves empty ones
    upto = np.concatenate([[0], np.cumsum(whole.to_numpy(zero_copy_only=False))])
    ends = split.offsets.to_numpy().astype(np.int64)
    return words.filter(whole), np.diff(upto[ends - ends[0]])


def _chunks(arriving: Iterator[pa.RecordBatch], column: int) -> Iterator[_Chunk]:
    """Texts as tokens, in bounded chunks."""
    parts, sizes, ids, size = [], [], [], 0

    def chunk() -> _Chunk:
        coded = pa.concat_arrays(parts).dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        whole = np.concatenate(sizes) + 1
        tokens = np.zeros(whole.sum(), np.int32)  # the end comes after the words of each text
        at = np.ones(len(tokens), bool)
        at[np.cumsum(whole) - 1] = False
        tokens[at] = coded.indices.to_numpy() + 2
        return _Chunk(ids, whole, tokens, _Places(zip(words, count_from(2))).hashes())

    for batch in arriving:
        texts = batch.column(column)
        for at in range(0, batch.num_rows, 500):
            some = texts.slice(at, 500)
            words, found = _words(some)
            ids += batch.column(0).slice(at, 500).to_pylist() if column else [None] * len(some)
            parts.append(words)
            sizes.append(found)
            size += len(words) + len(some)
            if size >= CHUNK_TOKENS or len(ids) >= CHUNK_TEXTS:
                yield chunk()
                parts, sizes, ids, size = [], [], [], 0
    if ids:
        yield chunk()


def _together(rows: Iterator[dict]) -> Iterator[dict]:
    """Packed rows as columns of some ROWS."""
    while some := list(islice(rows, ROWS)):
        yield {name: [row[name] for row in some] for name in some[0]}


def _class(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(56)).astype(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in sorted keys, -1 for others."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the places of the keys, which are below 2 ** 31."""
    ordered = np.sort(keys << 32 | np.arange(len(keys)))
    values, order = ordered >> 32, ordered & 0xFFFFFFFF
    fresh = np.diff(values, prepend=-1) != 0
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(fresh) - 1
    return values[fresh], at


@dataclass
class Frequent:
    """The words that are spread, sorted, and their counts; first the beginning
    of a text, which is a context alone."""

    words: np.ndarray
    counts: np.ndarray

    def find(self, words: np.ndarray) -> np.ndarray:
        return _find(self.words, words)


def _deal(words: np.ndarray, frequent: np.ndarray, parents: np.ndarray, count: int):
    """Frequent words are dealt by (word, parent), others by word."""
    with np.errstate(over="ignore"):
        salt = np.where(frequent >= 0, parents + 1, 0).astype(np.uint64) * ODD
        return (mix(words + salt) % np.uint64(count)).astype(np.int64)


def _shard(contexts: np.ndarray, count: int) -> np.ndarray:
    return (mix(contexts ^ ODD) % np.uint64(count)).astype(np.int64)


@lru_cache(16)
def _log_stirling(discount: float) -> np.ndarray:
    """log S(c, t) for up to EXACT customers."""
    table = np.full((EXACT + 1, EXACT + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(EXACT):
        for t in range(1, c + 2):
            more = table[c, t] + (np.log(c - discount * t) if t <= c and c > discount * t else -np.inf)
            table[c + 1, t] = np.logaddexp(table[c, t - 1], more)
    return table


def _draw_few(c, others, parent, discount: float, width: int, random: np.random.Generator):
    """The same draw for up to SMALL customers, whose weights need no logarithms."""
    stirling = np.exp(_log_stirling(discount))
    parent = np.maximum(parent, 1e-300)
    product, total = np.ones(len(c)), stirling[c, 1]
    upto = [total]
    for t in range(2, width + 1):
        product *= (STRENGTH + discount * (others + t - 1)) * parent
        total = total + product * stirling[c, t]
        upto.append(total)
    point = random.random(len(c)) * total
    return 1 + sum((x < point).astype(np.int64) for x in upto)


def draw_tables(
    customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float,
    random: np.random.Generator,
) -> np.ndarray:
    """Tables of each dish, given its customers, the tables of all other dishes
    of its restaurant and the parent's probability of the dish."""
    tables = np.minimum(customers, 1).astype(np.int64)
    stirling = _log_stirling(discount)
    low = 2
    for width in (2, 4, 8, 16, 32, EXACT):
        last = width == EXACT
        rows = np.flatnonzero((customers >= low) & ((customers <= width) | last))
        low = width + 1
        step = CELLS // width
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            c = np.minimum(customers[some], EXACT)
            if width <= SMALL:
                tables[some] = _draw_few(c, others[some], parent[some], discount, width, random)
                continue
            t = np.arange(1, width + 1)
            weight = np.log(STRENGTH + discount * (others[some][:, None] + t - 1))
            np.cumsum(weight, axis=1, out=weight)
            weight += stirling[c, 1 : width + 1]
            weight += t * np.log(np.maximum(parent[some], 1e-300))[:, None]
            weight -= weight.max(axis=1, keepdims=True)
            upto = np.cumsum(np.exp(weight, out=weight), axis=1, out=weight)
            point = random.random(len(some)) * upto[:, -1]
            tables[some] = 1 + (upto < point[:, None]).sum(axis=1)
    rows = np.flatnonzero(customers > EXACT)
    size, other, share, own = customers[rows], others[rows], parent[rows], tables[rows]
    seated = EXACT  # of every dish that has more
    while len(rows):
        group = np.minimum(max(1, int(seated * LEAP)), size - seated)
        fresh = (STRENGTH + discount * (other + own)) * share
        chance = fresh / (fresh + seated - discount * own)
        own += random.binomial(group, np.minimum(np.maximum(chance, 0), 1))
        seated += max(1, int(seated * LEAP))
        done = size <= seated
        if done.any():
            tables[rows[done]] = own[done]
            rows, size, other, share, own = (x[~done] for x in (rows, size, other, share, own))
    return tables


@dataclass
class Totals:
    """What a sweep leaves for all buckets: tables and customers of the root,
    the parents and the frequent contexts, and for frequent words what the root
    holds of them."""

    tables: list[np.ndarray]  # root, parents, frequent contexts
    customers: list[np.ndarray]
    root_customers: np.ndarray  # per frequent word
    root_tables: np.ndarray


@dataclass
class Model:
    frequent: Frequent
    buckets: int  # dishes by word
    shards: int  # other contexts
    tokens: int = 0
    words: int = 0
    contexts: int = 0
    discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    record: list[Totals] = field(default_factory=list)

    def base(self) -> float:
        return 1.0 / (self.words + 1)

    def root(self, at: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The root's probability of dishes after sweep ``at``."""
        past = self.record[at]
        d = self.discounts[0]
        rest = (STRENGTH + d * past.tables[0][0]) * self.base()
        return (customers - d * tables + rest) / (STRENGTH + past.customers[0][0])

    def parent(self, at: int, where, customers, tables, root):
        """The same for parents ``where``."""
        past = self.record[at]
        return self.seated(1, customers, tables, past.customers[1][where], past.tables[1][where], root)

    def seated(self, level: int, customers, tables, all_customers, all_tables, above):
        """The same for restaurants of known totals."""
        d = self.discounts[level]
        rest = (STRENGTH + d * all_tables) * above
        return (customers - d * tables + rest) / (STRENGTH + all_customers)


class Bucket:
    """All dishes of one bucket and their seating, sweep by sweep."""

    def __init__(self, row, frequent: Frequent):
        self.number, self.frequent = row["bucket"], frequent
        self.words = np.frombuffer(row["words"], np.uint64)
        self.word = np.repeat(np.arange(len(self.words)), np.frombuffer(row["sizes"], np.uint32))
        self.count = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.context = np.frombuffer(row["contexts"], np.uint16).astype(np.int64)
        self.spread = np.flatnonzero(self.context != OTHER)  # dishes of frequent contexts
        self.other = np.flatnonzero(self.context == OTHER)
        self.names = np.frombuffer(row["others"], np.uint64)  # sorted, and of each dish its place there
        self.named = _from_planes(row.get("named", b""), 1, len(self.other))[0].astype(np.int64)
        self.context[self.other] = len(frequent.words) + self.named
        self.pair_keys = self.word << 32 | self.context
        parent = _class(np.concatenate([frequent.words, self.names]))[self.context]
        self.parent_keys, self.under = _distinct(self.word << 8 | parent)
        self.parent_word, self.parent = self.parent_keys >> 8, self.parent_keys & 255
        self.place = frequent.find(self.words)  # among frequent words
        self.total = np.bincount(self.word, self.count, len(self.words)).astype(np.int64)
        # every dish begins with one table
        self.tables = np.ones(len(self.context), np.int64)
        self._carry_up(np.ones(len(self.parent_keys), np.int64))
        self.root_tables = np.minimum(self.root_customers, 1)
        # of other contexts, when known: customers, and totals of each sweep
        self.drawn = None
        if row.get("totals") is not None:
            n = len(self.names)
            self.drawn = tuple(
                np.frombuffer(row[c], np.uint32).astype(np.int64).reshape(-1, n)
                for c in ("customers", "totals") if n
            )
        # of each sweep drawn so far: tables of dishes, of parents and of words
        self.seats = [list(row[c]) if row.get(c) is not None else [] for c in _SEATS]

    def _carry_up(self, parent_tables) -> None:
        self.parent_customers = np.bincount(self.under, self.tables, len(self.parent_keys)).astype(np.int64)
        self.parent_tables = np.minimum(parent_tables, self.parent_customers)
        self.root_customers = np.bincount(
            self.parent_word, self.parent_tables, len(self.words)
        ).astype(np.int64)

    def probabilities(self, model: Model, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Of words at the root and of (word, parent) dishes, after sweep
        ``at``, which must be the present seating."""
        past = model.record[at]
        known = self.place >= 0
        customers = np.where(known, past.root_customers[self.place], self.root_customers)
        tables = np.where(known, past.root_tables[self.place], self.root_tables)
        root = model.root(at, customers, tables)
        parent = model.parent(
            at, self.parent, self.parent_customers, self.parent_tables, root[self.parent_word]
        )
        return root, parent

    def sweep(self, model: Model, at: int, whole: np.ndarray | None = None) -> None:
        """From the seating after sweep ``at`` to the next: a stored one, or one
        that is drawn given the tables in ``whole`` other contexts; those without a
        dish of several customers here are not looked at."""
        if at < len(self.seats[0]):
            sizes = len(self.context), len(self.parent_keys), len(self.words)
            self.tables, parents, self.root_tables = (
                _from_planes(stored[at], 1, n)[0].astype(np.int64) for stored, n in zip(self.seats, sizes)
            )
            self._carry_up(parents)
            return
        random = np.random.default_rng([17, at, self.number])
        past = model.record[at]
        root, parent = self.probabilities(model, at)
        others = np.append(past.tables[2], whole)[self.context] - self.tables
        self.tables = draw_tables(
            self.count, np.maximum(others, 0), parent[self.under], model.discounts[2], random
        )
        customers = np.bincount(self.under, self.tables, len(self.parent_keys)).astype(np.int64)
        others = past.tables[1][self.parent] - self.parent_tables
        self._carry_up(draw_tables(
            customers, np.maximum(others, 0), root[self.parent_word], model.discounts[1], random
        ))
        others = past.tables[0][0] - self.root_tables
        self.root_tables = draw_tables(
            self.root_customers, np.maximum(others, 0), np.full(len(self.words), model.base()),
            model.discounts[0], random,
        )

    def totals(self) -> list[np.ndarray]:
        """Sums that are added up over all buckets; see _merge_totals."""
        rare = self.place < 0
        known = self.place[~rare]
        size = len(self.frequent.words)
        singles = [
            [(x == 1).sum(), (x == 2).sum()]
            for x in (self.root_customers[rare], self.parent_customers, self.count)
        ]
        context = self.context[self.spread]
        return [
            np.array([
                self.root_tables[rare].sum(), self.root_customers[rare].sum(), *np.ravel(singles),
                rare.sum(), self.total.sum(),
            ]),
            np.bincount(self.parent, self.parent_tables, CLASSES),
            np.bincount(self.parent, self.parent_customers, CLASSES),
            np.bincount(context, self.tables[self.spread], size),
            np.bincount(context, self.count[self.spread], size),
            np.bincount(known, self.root_customers[~rare], size),
            np.bincount(known, self.total[~rare], size),
        ]

    def by_shard(self, shards: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Other contexts ``places`` in the order of their shards, and that of each."""
        shard = _shard(self.names[places], shards)
        order = np.argsort(shard, kind="stable")
        return places[order], shard[order]

    def crowded(self) -> np.ndarray:
        """Places of the other contexts with a dish of several customers here; the
        tables of all other dishes never change."""
        return np.unique(self.named[self.count[self.other] > 1])

    def told(self, model: Model, places: np.ndarray, first: bool = False) -> Iterator[dict]:
        """A row per shard with the tables that other contexts ``places`` have here
        at dishes of several customers; ``first``, also with their customers and
        the tables of single customers."""
        named, count = self.named, self.count[self.other]
        many, size = count > 1, len(self.names)
        sums = {"up_tables": np.bincount(named[many], self.tables[self.other][many], size)}
        if first:
            sums |= {"up_customers": np.bincount(named, count, size), "up_alone": np.bincount(named[~many], minlength=size)}
        places, shard = self.by_shard(model.shards, places)
        for number, a, b in _runs(shard):
            some = places[a:b]
            yield {"bucket": self.number, "shard": number, "names": self.names[some].tobytes()} | {
                c: _planes(x[some].astype(np.int64)) for c, x in sums.items()
            }

    def added(self) -> dict:
        """``totals`` in one row, without zeros."""
        sums = np.concatenate(self.totals()).astype(np.int64)
        some = np.flatnonzero(sums)
        return {"sum_keys": _bytes(some), "sums": _planes(sums[some])}


_SEATS = ("seats", "parents", "roots")
_PACKED = "bucket int, words binary, sizes binary, contexts binary, others binary, counts binary"
_PAIRS = _PACKED + ", named binary"  # others: once each
# a bucket: the tables of single customers in its crowded contexts, its seatings, its totals
_STATE = _PAIRS + ", alone binary, " + ", ".join(f"{c} array<binary>" for c in _SEATS)
_STEP = _STATE + (
    ", sum_keys binary, sums binary, shard int, names binary, up_tables binary, up_customers binary, up_alone binary"
)
_TOLD = "bucket int, shard int, names binary, tables binary, alone binary"
_CONTEXTS = "bucket int, shard int, names binary, customers binary, totals binary"
_SEATED = _PAIRS + ", customers binary, totals binary, " + ", ".join(f"{c} array<binary>" for c in _SEATS)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _frame(rows: list[dict], schema: str) -> pd.DataFrame:
    return pd.DataFrame([[row.get(c) for c in _names(schema)] for row in rows], columns=_names(schema), dtype=object)


def _pack(bucket: int, words, word_at, contexts, names, counts) -> dict:
    """Columns of one packed row; entries are sorted by word.  ``contexts`` are
    places among frequent words, -1 for others, whose hashes are ``names``."""
    first = np.flatnonzero(np.diff(word_at, prepend=-1))
    sizes = np.diff(np.append(first, len(word_at)))
    return {
        "bucket": bucket,
        "words": words[word_at[first]].tobytes(),
        "sizes": sizes.astype(np.uint32).tobytes(),
        "contexts": np.where(contexts < 0, OTHER, contexts).astype(np.uint16).tobytes(),
        "others": names[contexts < 0].tobytes(),
        "counts": counts.astype(np.uint32).tobytes(),
    }


def _frequent(training: DataFrame, size: int) -> Frequent:
    """Words that fill one place in FREQUENT of a sample of some SAMPLE_BYTES;
    at most FREQUENT words can hold such a share."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for chunk in _chunks(arriving, 0):
            yield {"word": chunk.words.view(np.int64), "n": np.bincount(chunk.tokens, minlength=len(chunk.words))}

    share = min(1.0, SAMPLE_BYTES / max(size, 1))
    sample = training.where(F.pmod(F.xxhash64(*training.columns), F.lit(1 << 20)) < share * (1 << 20))
    counts = _store(
        through_arrow(sample.select("text"), batches, "word long, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )
    tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counts.where((F.col("n") > 0) & (F.col("n") * FREQUENT >= tokens)).toArrow()
    words = np.append(often["word"].to_numpy().view(np.uint64), BEGIN)
    return Frequent(np.sort(words), np.zeros(len(words), np.int64))


def _pairs(training: DataFrame, model: Model) -> DataFrame:
    """One packed row per bucket: words, contexts and counts, and its totals while
    each dish has one table; then rows for the shards."""
    frequent, count = model.frequent, model.buckets

    def rows(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for chunk in _chunks(arriving, 0):
            words, place = chunk.words, frequent.find(chunk.words)
            keys, n = np.unique(chunk.tokens.astype(np.int64) << 32 | chunk.before(), return_counts=True)
            at, before = keys >> 32, keys & 0xFFFFFFFF
            dealt = _deal(words[at], place[at], _class(words)[before], count)
            order = np.argsort(dealt, kind="stable")
            cuts = np.flatnonzero(np.diff(dealt[order], prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                some = order[a:b]
                yield _pack(
                    int(dealt[some[0]]), words, at[some], place[before[some]], words[before[some]], n[some]
                )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([
            np.repeat(np.frombuffer(w, np.uint64), np.frombuffer(s, np.uint32))
            for w, s in zip(group["words"], group["sizes"])
        ])
        contexts = np.frombuffer(b"".join(group["contexts"]), np.uint16).astype(np.int64)
        counts = np.frombuffer(b"".join(group["counts"]), np.uint32)
        others = np.frombuffer(b"".join(group["others"]), np.uint64)
        names, named = np.unique(others, return_inverse=True)
        size = len(frequent.words)
        contexts[contexts == OTHER] = size + named
        every = np.concatenate([frequent.words, names])
        distinct, at = np.unique(words, return_inverse=True)
        keys, where = np.unique(at.astype(np.int64) << 32 | contexts, return_inverse=True)
        sums = np.bincount(where, counts, len(keys))
        contexts = keys & 0xFFFFFFFF
        row = _pack(
            int(group["bucket"].iloc[0]), distinct, keys >> 32,
            np.where(contexts < size, contexts, -1), every[contexts], sums,
        )
        named = contexts[contexts >= size] - size
        row |= {"others": names.tobytes(), "named": _planes(named)}
        bucket = Bucket(row, frequent)
        told = bucket.told(model, np.arange(len(names)), first=True)
        return _frame([row | bucket.added(), *told], _STEP)

    return through_arrow(
        training.select("text"), lambda arriving: _together(rows(arriving)), _PACKED
    ).groupBy("bucket").applyInPandas(merge, _STEP)


def _record(stored: DataFrame, model: Model) -> list[np.ndarray]:
    """The totals of all buckets; a bounded number of sums comes back."""
    sizes = (10, CLASSES, CLASSES, *[len(model.frequent.words)] * 4)
    size = sum(sizes)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = np.zeros(size, np.int64)
        for batch in arriving:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["sum_keys"], np.uint32)
                sums[keys] += _from_planes(row["sums"], 1, len(keys))[0].astype(np.int64)
        some = np.flatnonzero(sums)
        yield {"key": some, "value": sums[some]}

    found = (
        through_arrow(stored.where("shard is null").select("sum_keys", "sums"), batches, "key long, value long")
        .groupBy("key").agg(F.sum("value").alias("value")).toArrow()
    )
    sums = np.zeros(size, np.int64)
    sums[found["key"].to_numpy()] = found["value"].to_numpy()
    return np.split(sums, np.cumsum(sizes)[:-1])


def _merge_totals(model: Model, sums: list[np.ndarray], at: int) -> Totals:
    customers = sums[5]
    tables = np.minimum(customers, 1)
    if at:
        before = model.record[-1]
        others = np.maximum(before.tables[0][0] - before.root_tables, 0)
        tables = draw_tables(
            customers, others, np.full(len(customers), model.base()), model.discounts[0],
            np.random.default_rng([18, at]),
        )
    return Totals(
        [np.array([sums[0][0] + tables.sum()]), sums[1], sums[3]],
        [np.array([sums[0][1] + customers.sum()]), sums[2], sums[4]],
        customers,
        tables,
    )


def _bytes(values) -> bytes:
    return np.asarray(values).astype(np.uint32).tobytes()


def _planes(values) -> bytes:
    """Numbers in as few bytes as the largest needs; all their first bytes, then
    all second ones and so on, which are compressed better."""
    values = np.asarray(values)
    narrow = values.astype(np.min_scalar_type(values.max(initial=0)))
    return narrow.reshape(-1, 1).view(np.uint8).T.tobytes()


def _from_planes(packed: bytes, rows: int, size: int) -> np.ndarray:
    width = max(1, len(packed) // max(1, rows * size))
    planes = np.frombuffer(packed, np.uint8).reshape(width, rows * size)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(rows, size)


def _joined(packed: pd.Series, sizes: Sequence[int]) -> np.ndarray:
    """Numbers of all rows, each packed by ``_planes``."""
    parts = [_from_planes(row, 1, n)[0].astype(np.int64) for row, n in zip(packed, sizes)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _whole(stored: DataFrame, first: bool) -> DataFrame:
    """The tables of other contexts at dishes of several customers: a row per
    (bucket, shard) for the contexts that are crowded there, and one per shard with
    all of them, whose bucket is below zero; ``first``, also those of single ones."""

    def add(key, told: pd.DataFrame) -> pd.DataFrame:
        told = told.sort_values("bucket")
        names, at = np.unique(np.frombuffer(b"".join(told["names"]), np.uint64), return_inverse=True)
        sizes = told["names"].map(len).to_numpy() // 8
        here = _joined(told["up_tables"], sizes)
        tables = np.bincount(at, here, len(names)).astype(np.int64)
        if first:
            alone = np.bincount(at, _joined(told["up_alone"], sizes), len(names)).astype(np.int64)
        found = [{"bucket": -1 - int(key[0]), "shard": int(key[0]), "names": names.tobytes(), "tables": _planes(tables)}]
        end = np.cumsum(sizes)
        for number, a, b in zip(told["bucket"], end - sizes, end):
            some = at[a:b][here[a:b] > 0]
            if len(some):
                found.append({"bucket": int(number), "shard": int(key[0]), "tables": _planes(tables[some])})
                if first:
                    found[-1]["alone"] = _planes(alone[some])
        return _frame(found, _TOLD)

    told = stored.where("shard is not null").select("shard", "bucket", "names", "up_tables", "up_alone")
    return told.groupBy("shard").applyInPandas(add, _TOLD)


def _sweep(stored: DataFrame, whole: DataFrame, model: Model, at: int) -> DataFrame:
    """All buckets from the seating after sweep ``at`` to the next."""
    shared = stored.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in _names(_STATE) if c in stored.columns]

    def draw(key, states: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        row = states.iloc[0].to_dict()
        bucket, told = Bucket(row, model.frequent), told.sort_values("shard")
        if at:
            bucket.sweep(model, at - 1)
        crowded = bucket.crowded()
        places, shard = bucket.by_shard(model.shards, crowded)
        sizes = [b - a for _, a, b in _runs(shard)]
        if not at:
            row["alone"] = _planes(_joined(told["alone"], sizes))
        tables = np.zeros(len(bucket.names), np.int64)
        tables[places] = _from_planes(row["alone"], 1, len(places))[0] + _joined(told["tables"], sizes)
        bucket.sweep(model, at, tables)
        drawn = bucket.tables, bucket.parent_tables, bucket.root_tables
        row |= {c: [*before, _planes(now)] for c, before, now in zip(_SEATS, bucket.seats, drawn)}
        return _frame([row | bucket.added(), *bucket.told(model, crowded)], _STEP)

    return stored.where("shard is null").select(*kept).groupBy("bucket").cogroup(
        whole.where("bucket >= 0").select("bucket", "shard", "tables", "alone").groupBy("bucket")
    ).applyInPandas(draw, _STEP)


def _contexts(first: DataFrame, wholes: Sequence[DataFrame]) -> DataFrame:
    """Customers of the other contexts and their tables after each sweep: a row per
    (bucket, shard) in the order of ``Bucket.by_shard``, and one per shard with all
    of them, whose bucket is below zero."""
    sweeps = len(wholes)

    def add(key, told: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        told = told.sort_values("bucket")
        names, at = np.unique(np.frombuffer(b"".join(told["names"]), np.uint64), return_inverse=True)
        sizes = told["names"].map(len).to_numpy() // 8
        customers, alone = (
            np.bincount(at, _joined(told[c], sizes), len(names)).astype(np.int64)
            for c in ("up_customers", "up_alone")
        )
        totals = np.tile(alone, (sweeps, 1))
        for row in sums.itertuples(index=False):
            some = np.frombuffer(row.names, np.uint64)
            totals[row.sweep, np.searchsorted(names, some)] += _from_planes(row.tables, 1, len(some))[0].astype(np.int64)
        found = [{
            "bucket": -1 - int(key[0]), "shard": int(key[0]), "names": names.tobytes(),
            "customers": _bytes(customers), "totals": _bytes(totals),
        }]
        end = np.cumsum(sizes)
        for number, a, b in zip(told["bucket"], end - sizes, end):
            here = at[a:b]
            found.append({
                "bucket": int(number), "shard": int(key[0]),
                "customers": _bytes(customers[here]), "totals": _bytes(totals[:, here]),
            })
        return _frame(found, _CONTEXTS)

    told = first.where("shard is not null").select("shard", "bucket", "names", "up_customers", "up_alone")
    sums = reduce(DataFrame.unionByName, [
        whole.where("bucket < 0").select("shard", "names", "tables", F.lit(at).alias("sweep"))
        for at, whole in enumerate(wholes)
    ])
    return told.groupBy("shard").cogroup(sums.groupBy("shard")).applyInPandas(add, _CONTEXTS)


def _attach(stored: DataFrame, contexts: DataFrame, model: Model, sweeps: int) -> DataFrame:
    """The buckets with the customers and tables of all their other contexts."""
    frequent, shards = model.frequent, model.shards
    kept = [c for c in _names(_SEATED) if c in stored.columns]

    def join(key, states: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = states.iloc[0].to_dict()
        bucket, found = Bucket(row, frequent), found.sort_values("shard")
        places, _ = bucket.by_shard(shards, np.arange(len(bucket.names)))
        for column, count in (("customers", 1), ("totals", sweeps)):
            parts = [np.frombuffer(v, np.uint32).reshape(count, -1) for v in found[column]]
            placed = np.empty((count, len(places)), np.uint32)
            if parts:
                placed[:, places] = np.concatenate(parts, axis=1)
            row[column] = placed.tobytes()
        return _frame([row], _SEATED)

    return stored.where("shard is null").select(*kept).groupBy("bucket").cogroup(
        contexts.where("bucket >= 0").select("bucket", "shard", "customers", "totals").groupBy("bucket")
    ).applyInPandas(join, _SEATED)


@dataclass
class Seating:
    """Stored tables: the dishes by bucket, the other contexts by shard."""

    dishes: DataFrame
    contexts: DataFrame


def fit(training: DataFrame, *, sweeps: int = SWEEPS) -> tuple[Model, Seating]:
    """Model and seating of rows with a column ``text``; ``sweeps`` from 1."""
    size = training.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, shards = (max(width, -(-size // part)) for part in (BUCKET_BYTES, SHARD_BYTES))
    model = Model(_frequent(training, size), buckets, shards)
    first = stored = _store(_pairs(training, model))
    sums = _record(first, model)
    once, twice = sums[0][2:8:2], sums[0][3:8:2]
    guess = np.clip(once / np.maximum(once + 2 * twice, 1), 0.05, 0.95)
    model.discounts = tuple(float(x) for x in guess)
    model.frequent.counts = sums[6]
    model.words = int(sums[0][8] + (sums[6] > 0).sum())
    model.tokens = int(sums[0][9])
    model.record.append(_merge_totals(model, sums, 0))
    whole, wholes = _store(_whole(first, True)), []
    for at in range(sweeps):
        before, stored = stored, _store(_sweep(stored, whole, model, at))
        if at:
            _drop(before)
        model.record.append(_merge_totals(model, _record(stored, model), at + 1))
        whole = _store(_whole(stored, False))
        wholes.append(whole)
    contexts = _store(_contexts(first, wholes))
    _drop(first)
    seated = _store(_attach(stored, contexts, model, sweeps))
    _drop(stored)
    whole = _store(contexts.where("bucket < 0").select("shard", "names", "customers", "totals"))
    _drop(contexts)
    model.contexts = int((sums[4] > 0).sum()) + (
        whole.agg(F.coalesce(F.sum(F.octet_length("names")), F.lit(0))).first()[0] // 8
    )
    return model, Seating(seated, whole)


def _averaged(sweeps: int, burn_in: int) -> list[int]:
    return [at for at in range(sweeps + 1) if at > burn_in or at == sweeps]


def _and_none(values: np.ndarray) -> np.ndarray:
    """With a last 0, which place -1 finds."""
    return np.append(values, 0)


@dataclass
class _Sample:
    """What one averaged sweep says to a bucket."""

    at: int
    frequent: np.ndarray  # the root's probabilities of frequent words
    root: np.ndarray  # of the bucket's words
    parent: np.ndarray  # of its (word, parent) dishes
    tables: np.ndarray  # of its dishes
    all_customers: np.ndarray  # of its contexts
    all_tables: np.ndarray


class _Scorer:
    """A bucket with the predictive probabilities that are averaged."""

    def __init__(self, bucket: Bucket, model: Model, burn_in: int):
        self.bucket, self.model, self.samples = bucket, model, []
        self.total, self.count = _and_none(bucket.total), _and_none(bucket.count)
        self.names, self.pairs, self.parents = map(pd.Index, (bucket.names, bucket.pair_keys, bucket.parent_keys))
        sweeps = len(model.record) - 1
        for at in range(sweeps + 1):
            if at:
                bucket.sweep(model, at - 1)
            if at in _averaged(sweeps, burn_in):
                self.samples.append(self._sample(at))

    def _sample(self, at: int) -> _Sample:
        bucket, past = self.bucket, self.model.record[at]
        root, parent = bucket.probabilities(self.model, at)
        all_customers, all_tables = past.customers[2], past.tables[2]
        if len(bucket.names) and at:
            all_customers = np.append(all_customers, bucket.drawn[-2][0])
            all_tables = np.append(all_tables, bucket.drawn[-1][at - 1])
        return _Sample(
            at, self.model.root(at, past.root_customers, past.root_tables), _and_none(root),
            _and_none(parent), _and_none(bucket.tables), all_customers, all_tables,
        )

    def score(self, words, sizes, contexts, others):
        """Per token: log10 probability (0 where its context must be asked),
        log10 base probability, known; then which are to be asked, and for
        those the parent's probability in each sample."""
        bucket, model = self.bucket, self.model
        frequent = model.frequent
        at, place = _find(bucket.words, words), frequent.find(words)
        count = self.total[at]
        count = np.where(place >= 0, frequent.counts[place], count)
        plain = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
        row = np.repeat(np.arange(len(words)), sizes)
        context = contexts.astype(np.int64)
        unlike = np.flatnonzero(context == OTHER)
        name = self.names.get_indexer(others)
        context[unlike] = np.where(name >= 0, len(frequent.words) + name, -1)
        classes = _class(frequent.words)[np.maximum(np.where(contexts == OTHER, 0, context), 0)]
        classes[unlike] = _class(others)
        asked = context < 0
        # a word the bucket does not hold has place 2 ** 30, beyond all keys
        dealt = np.where(at >= 0, at, 1 << 30)[row]
        pair = self.pairs.get_indexer(dealt << 32 | np.maximum(context, 0))
        dish = self.parents.get_indexer(dealt << 8 | classes)
        seen = (pair >= 0) & ~asked
        customers = np.where(seen, self.count[pair], 0)
        chance, above = np.zeros(len(row)), []
        known = np.maximum(context, 0)
        for sample in self.samples:
            sweep = sample.at
            first = np.where(at >= 0, sample.root[at], model.root(sweep, 0, 0))
            first = np.where(place >= 0, sample.frequent[place], first)[row]
            second = model.parent(sweep, classes, 0, 0, first)
            second = np.where(dish >= 0, sample.parent[dish], second)
            above.append(second[asked])
            held = np.where(seen, sample.tables[pair], 0)
            chance += model.seated(
                2, customers, held, sample.all_customers[known], sample.all_tables[known], second
            )
        logs = np.where(asked, 0.0, np.log10(chance / len(self.samples)))
        return logs, plain[row], (count > 0)[row], asked, np.array(above)


_REQUEST = (
    "bucket int, block long, words binary, sizes binary, contexts binary, others binary, "
    "texts binary, ids array<long>"
)
_ANSWER = (
    "block long, ids array<long>, tokens binary, texts binary, score binary, base binary, known binary, "
    "shard int, names binary, above binary, blocks binary"
)


def _requests(documents: DataFrame, model: Model, part: int, parts: int) -> DataFrame:
    """The words of blocks of texts by bucket, and one row per block that
    carries its ids and goes to a bucket number of its own, below zero.  Of all
    texts one part, by hash."""
    frequent, count = model.frequent, model.buckets
    texts = documents.select("doc_id", "text").where(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == part
    )

    def rows(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        partition = TaskContext.get().partitionId()
        for number, chunk in enumerate(_chunks(arriving, 1)):
            block = (partition * parts + part) << 32 | number
            empty = dict.fromkeys(("words", "sizes", "contexts", "others", "counts", "texts", "ids"))
            yield empty | {
                "bucket": -1 - (block * 31 + number) % count, "block": block,
                "sizes": _bytes(chunk.sizes), "ids": chunk.ids,
            }
            texts = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes).astype(np.uint16)
            words, at, before = chunk.words, chunk.tokens, chunk.before()
            place = frequent.find(words)
            dealt = _deal(words[at], place[at], _class(words)[before], count) << 32 | at
            order = np.argsort(dealt, kind="stable")
            dealt = dealt[order] >> 32
            cuts = np.flatnonzero(np.diff(dealt, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                some = order[a:b]
                row = _pack(
                    int(dealt[a]), words, at[some], place[before[some]], words[before[some]], some[:0]
                )
                yield empty | row | {"block": block, "texts": texts[some].tobytes()}

    return through_arrow(texts, lambda arriving: _together(rows(arriving)), _REQUEST)


def _portions(asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Requests of some SCORED_TOKENS together."""
    upto = asked["texts"].map(len).to_numpy().cumsum() // 2
    for _, some in asked.groupby(upto // SCORED_TOKENS):
        yield some


def _answers(scorer: _Scorer, asked: pd.DataFrame, shards: int) -> list[dict]:
    """For each request its sums per text, and what goes on to each shard, in
    one row per shard."""

    def joined(column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(asked[column]), kind)

    blocks = asked["block"].tolist()
    texts, contexts, others = joined("texts", np.uint16), joined("contexts", np.uint16), joined("others", np.uint64)
    block = np.repeat(np.arange(len(asked)), asked["texts"].map(len) // 2)
    logs, plain, known, open_, above = scorer.score(
        joined("words", np.uint64), joined("sizes", np.uint32), contexts, others
    )
    # every request has places for its texts up to the last one
    firsts = np.flatnonzero(np.diff(block, prepend=-1))
    room = np.zeros(len(asked), np.int64)
    room[block[firsts]] = np.maximum.reduceat(texts, firsts) + np.int64(1) if len(firsts) else 0
    starts = np.cumsum(room) - room
    at = starts[block] + texts
    held = np.flatnonzero(np.bincount(at, minlength=room.sum()))
    sums = [np.bincount(at, x, room.sum())[held] for x in (logs, plain, known)]
    owner = np.repeat(np.arange(len(asked)), room)[held]
    texts_held = (held - starts[owner]).astype(np.uint16)
    found = []
    for one, a, b in _runs(owner):
        found.append({
            "block": blocks[one], "texts": texts_held[a:b].tobytes(),
            "score": sums[0][a:b].tobytes(), "base": sums[1][a:b].tobytes(), "known": _bytes(sums[2][a:b]),
        })
    # the words that go on to a shard do so together, each with its block
    names = others[open_[contexts == OTHER]]
    shard = _shard(names, shards)
    order = np.argsort(shard, kind="stable")
    which = np.array(blocks, np.int64)[block[open_]]
    for place, a, b in _runs(shard[order]):
        some = order[a:b]
        found.append({
            "shard": place, "names": names[some].tobytes(), "texts": texts[open_][some].tobytes(),
            "above": above[:, some].astype(np.float32).tobytes(), "blocks": which[some].tobytes(),
        })
    return found


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of a sorted array with the places where its run begins and ends."""
    cuts = np.flatnonzero(np.diff(values, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(values))):
        yield int(values[a]), a, b


def score_texts(
    documents: DataFrame, model: Model, seating: Seating, *, burn_in: int = BURN_IN, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of rows (doc_id, text).

    The texts are scored in ``rounds`` parts, so that only the requests and the
    answers of one part are on disk at a time; parts do not change a score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = [f.split()[0] for f in _ANSWER.split(", ")]
    sweeps = _averaged(len(model.record) - 1, burn_in)
    shards, discount = model.shards, model.discounts[2]

    def answer(key, asked: pd.DataFrame, dishes: pd.DataFrame) -> pd.DataFrame:
        found = []
        if key[0] < 0:
            found = [
                {"block": block, "ids": ids, "tokens": sizes}
                for block, ids, sizes in zip(asked["block"], asked["ids"], asked["sizes"])
            ]
        elif len(asked):
            model = shared.value
            empty = dict.fromkeys(("words", "sizes", "contexts", "others", "counts"), b"")
            row = {"bucket": int(key[0]), **empty} if dishes.empty else dishes.iloc[0].to_dict()
            scorer = _Scorer(Bucket(row, model.frequent), model, burn_in)
            for some in _portions(asked):
                found += _answers(scorer, some, shards)
        whole = [[row.get(c) for c in columns] for row in found]
        return pd.DataFrame(whole, columns=columns, dtype=object)

    def follow(key, asked: pd.DataFrame, contexts: pd.DataFrame) -> pd.DataFrame:
        """Sums per text of the words whose contexts were asked."""
        if asked.empty:
            return pd.DataFrame([], columns=["block", "texts", "score"])
        names = np.frombuffer(b"".join(contexts["names"]), np.uint64)
        customers = np.frombuffer(b"".join(contexts["customers"]), np.uint32)
        totals = np.frombuffer(b"".join(contexts["totals"]), np.uint32)
        totals = totals.reshape(-1, len(names)) if len(names) else totals
        at = _find(names, np.frombuffer(b"".join(asked["names"]), np.uint64))
        above = np.concatenate(
            [np.frombuffer(a, np.float32).reshape(len(sweeps), -1) for a in asked["above"]], axis=1
        )
        chance = np.zeros(len(at))
        for sweep, share in zip(sweeps, above):
            open_share = np.ones(len(at))
            if len(names):
                whole = (STRENGTH + discount * totals[sweep - 1]) / (STRENGTH + customers)
                open_share = np.where(at >= 0, whole[at], 1.0)
            chance += open_share * share
        logs = np.log10(chance / len(sweeps))
        blocks, block = np.unique(np.frombuffer(b"".join(asked["blocks"]), np.int64), return_inverse=True)
        keys = block << 16 | np.frombuffer(b"".join(asked["texts"]), np.uint16)
        # in a fixed order, however the requests arrived
        order = np.lexsort((logs, keys))
        keys, at = np.unique(keys[order], return_inverse=True)
        sums = np.bincount(at, logs[order], len(keys))
        return pd.DataFrame(
            [
                (blocks[one], (keys[a:b] & 0xFFFF).astype(np.uint16).tobytes(), sums[a:b].tobytes())
                for one, a, b in _runs(keys >> 16)
            ],
            columns=["block", "texts", "score"],
        )

    def add(block: pd.DataFrame) -> pd.DataFrame:
        head = block[block["tokens"].notna()].iloc[0]
        ids = head["ids"]
        sums = {c: np.zeros(len(ids)) for c in ("score", "base", "known")}
        # in a fixed order, so that sums of doubles are the same at each run
        for row in block.sort_values(["score", "base", "texts"], na_position="first").itertuples(index=False):
            if row.texts is None:
                continue
            texts = np.frombuffer(row.texts, np.uint16)
            for column, kind in (("score", np.float64), ("base", np.float64), ("known", np.uint32)):
                if getattr(row, column) is not None:
                    sums[column][texts] += np.frombuffer(getattr(row, column), kind)
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"),
            "n_tokens": np.frombuffer(head["tokens"], np.uint32).astype(np.int64),
            "n_known": sums["known"].astype(np.int64),
            "base_score": sums["base"], "score": sums["score"],
        })

    def scored(part: int) -> DataFrame:
        answers = _store(
            _requests(documents, model, part, rounds).groupBy("bucket")
            .cogroup(seating.dishes.groupBy("bucket"))
            .applyInPandas(answer, _ANSWER)
        )
        followed = (
            answers.where("shard is not null").select("shard", "blocks", "texts", "names", "above")
            .groupBy("shard").cogroup(seating.contexts.groupBy("shard"))
            .applyInPandas(follow, "block long, texts binary, score binary")
        )
        sums = _store(
            answers.where("shard is null").drop("shard", "names", "above", "blocks")
            .unionByName(followed, allowMissingColumns=True)
            .groupBy("block")
            .applyInPandas(add, "doc_id long, n_tokens long, n_known long, base_score double, score double")
        )
        _drop(answers)
        return sums

    # each part is added up and its answers given back before the next begins
    return reduce(DataFrame.unionByName, [scored(part) for part in range(rounds)])


def score_corpus(
    documents: DataFrame,
    trains: Column,
    *,
    sweeps: int = SWEEPS,
    burn_in: int = BURN_IN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, Model]:
    """Learn from rows where ``trains`` holds (said of ``doc_id``), score all."""
    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    model, seating = fit(rows.where(trains), sweeps=sweeps)
    return score_texts(rows, model, seating, burn_in=burn_in), model

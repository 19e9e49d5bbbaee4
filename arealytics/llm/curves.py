"""Approximate nearest neighbours on shifted space-filling curves.

Unit vectors are projected to a few random directions, once per curve, shifted
by a random offset and put on a Hilbert curve.  Spark range-partitions the rows
by (curve, key); every row then has a place on each curve.  A query meets the
rows within a window of places on each curve, and what the windows bring
together is ranked by the true cosine.

Equal vectors share one place, held by a class that knows its smallest ids, so
a vector that many rows repeat neither fills a window nor hides its smaller ids.

The window is not guessed.  A fixed number of queries is compared with all
rows, and the window is the distance on the best curve within which the wanted
share of those true neighbours lies.  Structured data get short windows; data
without near neighbours get long ones, because nothing shorter reaches the
recall.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; of rows that share an id
the smallest vector counts; shorter vectors are filled up with zeros; ties go
to the smaller id; fewer candidates give fewer rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arealytics.llm.common import groups_of, through_arrow
from arealytics.llm.vectors import lists, matrix, same_width, usable
from arealytics.operators.keys import in_ranges, with_offset
from arealytics.session import pin

CURVES = 8
DIRECTIONS = 10
BITS = 6
BLOCK = 2048  # places that one task compares at once
FIT_SAMPLE = 4096  # vectors that scale the projections
TRIAL_QUERIES = 128  # queries that set the window
TRIAL_RECALL = 0.97
_TIE = 1e-12


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (n, d) on the Hilbert curve of ``bits`` bits a
    dimension: reflections undone from the top bit, Gray code, interleaving."""
    axes = [c.astype(np.int64) for c in cells.T]
    first, last = axes[0], len(axes) - 1
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(last + 1):
            set_here = (axes[i] & bit) != 0
            swap = np.where(set_here, 0, (first ^ axes[i]) & below)
            first = axes[0] = np.where(set_here, first ^ below, first ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, last + 1):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(first)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[last] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(first)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


class Frame:
    """Directions, scale and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, directions: int, bits: int, seed: int):
        random = np.random.default_rng(seed)
        self.width, self.bits = sample.shape[1], bits
        self.directions = random.standard_normal((curves, self.width, directions))
        self.shifts = random.random((curves, directions))
        flat = np.stack([sample @ d for d in self.directions])
        self.middle = flat.mean(axis=1, keepdims=True)
        self.spread = np.maximum(flat.std(axis=1, keepdims=True), 1e-9)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(curves, n) places; each curve sees the points shifted in a box of
        twice their width, so borders of cells fall elsewhere on each."""
        unit = unit[:, : self.width]
        if unit.shape[1] < self.width:
            unit = np.pad(unit, ((0, 0), (0, self.width - unit.shape[1])))
        found = []
        for way, shift, middle, spread in zip(
            self.directions, self.shifts, self.middle, self.spread
        ):
            place = np.clip((unit @ way - middle) / spread / 8 + 0.5, 0.0, 1.0 - 1e-12)
            cells = ((place + shift) / 2 * (1 << self.bits)).astype(np.int64)
            found.append(hilbert(cells, self.bits))
        return np.stack(found)


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows; the same pair always gives the same double."""
    with np.errstate(over="ignore"):
        return (a * b).sum(axis=1) / (
            np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
        )


def classes(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(class_id, vector, members, asked): equal vectors once, with their k+1
    smallest ids, of which at most one is a query itself."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    # the limit is applied before the shuffle as well, so no group gathers
    smallest = (
        rows.withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    )
    asked = rows.where(is_query).select("vector").distinct().withColumn("asked", F.lit(True))
    return smallest.join(asked, "vector", "left").select(
        F.col("members")[0].alias("class_id"),
        "vector",
        "members",
        F.coalesce("asked", F.lit(False)).alias("asked"),
    )


def _places(index: DataFrame, frame: Frame) -> DataFrame:
    """(curve, class_id, place) for every class on every curve."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            if not batch.num_rows:
                continue
            keys = frame.keys(units(matrix(batch.column(1))))
            for curve, found in enumerate(keys):
                yield {
                    "curve": np.full(len(found), curve, np.int32),
                    "key": found,
                    "class_id": batch.column(0),
                }

    keyed = through_arrow(
        index.select("class_id", "vector"), batches, "curve int, key long, class_id long"
    )
    ranged = in_ranges(keyed, ["curve", "key", "class_id"])
    return with_offset(ranged, F.count(F.lit(1))).select(
        "curve", "class_id", (F.col("_offset") + F.col("_place")).alias("place")
    )


def _best_rows(queries, query_ids, vectors, ids, wanted, allowed=None):
    """(query row, candidate row) of the ``wanted`` best classes per query."""
    scores = units(queries) @ units(vectors).T
    if allowed is not None:
        scores = np.where(allowed, scores, -np.inf)
    kept = min(wanted, scores.shape[1])
    edge = -np.partition(-scores, kept - 1, axis=1)[:, kept - 1 : kept]
    rows, columns = np.nonzero((scores >= edge - _TIE) & np.isfinite(scores))
    exact = cosine(queries[rows], vectors[columns])
    order = np.lexsort((ids[columns], -exact, rows))
    rows, columns, exact = rows[order], columns[order], exact[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    good = rank < wanted
    return rows[good], columns[good], exact[good]


def _best_classes(found: DataFrame, wanted: int) -> DataFrame:
    order = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    return (
        found.groupBy("query_class", "class_id")
        .agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= wanted)
        .drop("_n")
    )


def window_for(index: DataFrame, places: DataFrame, k: int, recall: float) -> int:
    """Places within which ``recall`` of the true neighbours of a fixed number
    of queries lie, on the best curve of each."""
    trial = (
        index.where("asked").orderBy(F.xxhash64("class_id")).limit(TRIAL_QUERIES)
        .select("class_id", "vector").toArrow()
    )
    if not trial.num_rows:
        return 1
    asked_ids, asked = trial["class_id"].to_numpy(), matrix(trial["vector"])

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            for at in range(0, batch.num_rows, 4 * BLOCK):
                some = batch.slice(at, 4 * BLOCK)
                ids = some.column(0).to_numpy()
                a, b = same_width(asked, matrix(some.column(1)))
                rows, columns, scores = _best_rows(
                    a, asked_ids, b, ids, k, asked_ids[:, None] != ids[None, :]
                )
                yield {"query_class": asked_ids[rows], "class_id": ids[columns], "score": scores}

    schema = "query_class long, class_id long, score double"
    true = pin(_best_classes(
        through_arrow(index.select("class_id", "vector"), batches, schema), k
    ))
    own = places.select("curve", F.col("class_id").alias("query_class"), F.col("place").alias("own"))
    gaps = (
        true.join(places, "class_id").join(own, ["query_class", "curve"])
        .groupBy("query_class", "class_id")
        .agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap"))
    )
    found = gaps.agg(F.percentile("gap", F.lit(recall))).first()[0]
    return int(np.ceil(found or 0)) + 1


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int,
    *,
    curves: int = CURVES,
    recall: float = TRIAL_RECALL,
    window: int | None = None,
    seed: int = 7,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for
    each query row.  ``is_query`` speaks of ``vec_id``."""
    rows = pin(
        usable(table, id_column, vector_column).where(F.exists("vector", lambda x: x != 0))
    )
    index = pin(classes(rows, is_query, k))
    # a fixed number of vectors
    fitted = index.orderBy(F.xxhash64("class_id")).limit(FIT_SAMPLE).select("vector").toArrow()
    if not fitted.num_rows:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
            F.lit(0.0).alias("score"),
        )
    frame = Frame(units(matrix(fitted["vector"])), curves, DIRECTIONS, BITS, seed)
    places = pin(_places(index, frame))
    reach = window or window_for(index, places, k, recall)
    found = _in_windows(index, places, reach, k)
    best = pin(_best_classes(found, k + 1))

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    members = index.select("class_id", "members")
    asked = queries.join(
        index.where("asked").select(F.col("class_id").alias("query_class"), "vector"), "vector"
    ).select("query_id", "query_class")
    listed = best.join(members, "class_id").select(
        "query_class", "score", F.explode("members").alias("vec_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(listed, "query_class")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _in_windows(index: DataFrame, places: DataFrame, reach: int, k: int) -> DataFrame:
    """The k+1 best classes of every asked class in each block its window
    touches.  Blocks are runs of places on one curve."""
    spots = places.join(index.select("class_id", "vector", "asked"), "class_id")
    in_block = spots.select(
        F.floor(F.col("place") / BLOCK).alias("block"), F.lit(0).alias("kind"),
        "curve", "place", "class_id", "vector",
    )
    near = F.sequence(
        F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / BLOCK),
        F.floor((F.col("place") + reach) / BLOCK),
    )
    asking = spots.where("asked").select(
        F.explode(near).alias("block"), F.lit(1).alias("kind"),
        "curve", "place", "class_id", "vector",
    )
    together = in_block.unionByName(asking)
    width = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = together.repartition(width, "block").sortWithinPartitions("block", "kind")

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, group in groups_of(arriving, "block"):
            kind = group["kind"].to_numpy()
            edge = int(np.searchsorted(kind, 1))
            there, asking = group.slice(0, edge), group.slice(edge)
            if not there.num_rows or not asking.num_rows:
                continue
            vectors, ids = matrix(there["vector"]), there["class_id"].to_numpy()
            curve, place = there["curve"].to_numpy(), there["place"].to_numpy()
            for at in range(0, asking.num_rows, 512):
                some = asking.slice(at, 512)
                own_ids = some["class_id"].to_numpy()
                allowed = (some["curve"].to_numpy()[:, None] == curve) & (
                    np.abs(some["place"].to_numpy()[:, None] - place) <= reach
                )
                a, b = same_width(matrix(some["vector"]), vectors)
                rows, columns, scores = _best_rows(a, own_ids, b, ids, k + 1, allowed)
                yield {"query_class": own_ids[rows], "class_id": ids[columns], "score": scores}

    return through_arrow(dealt, batches, "query_class long, class_id long, score double")

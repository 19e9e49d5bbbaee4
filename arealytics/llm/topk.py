"""Exact top-k search by inner product, with norm-bucketed retrieval.

Candidates are range-partitioned by falling length into groups of buckets.
Every query first meets the longest vectors of all, a fixed number, which gives
a score its k-th result reaches at least.  From that follows the shortest
vector that can still matter: a block of queries is only sent to the groups
that reach it.  Inside a group buckets come in order of length.  For each
bucket the score still needed, over the lengths of query and bucket, is a local
cosine threshold: above 1 the bucket is skipped; when it is high, the largest
coordinate of the query bounds the same coordinate of a candidate; otherwise
candidates too short for it are cut off.  Whoever is left is verified with the
exact integer product.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; of rows that share an id the smallest
vector counts; shorter vectors are filled up with zeros; ties go to the smaller
id; fewer candidates than k give fewer rows; scores beyond a 64-bit integer are
given as its nearest bound; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arealytics.llm.common import through_arrow
from arealytics.llm.vectors import lists, matrix, same_width, usable
from arealytics.session import pin

BUCKET = 1024  # vectors of like length
GROUP = 16 * BUCKET  # candidates that one task holds
QUERY_BLOCK = 1024
SEED_VECTORS = 1024
COORDINATE_FROM = 0.5  # local cosine threshold from which coordinates prune
_SLACK = 1e-9  # lengths are rounded, bounds must not be


def scaled(rows: DataFrame, factor: float) -> DataFrame:
    """Add integer components floor(factor * x), kept as doubles, and length."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            values = np.floor(factor * matrix(batch.column(1)))
            yield {
                "vec_id": batch.column(0),
                "vector": lists(values) if batch.num_rows else [],
                "length": np.sqrt((values * values).sum(axis=1)),
            }

    return through_arrow(
        rows.select("vec_id", "vector"), batches, "vec_id long, vector array<double>, length double"
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows: in doubles while every sum is an
    exact double, else in Python integers."""
    a, b = same_width(a, b)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    low, high = -(2**63), 2**63 - 1
    return np.array(
        [
            [min(high, max(low, sum(x * y for x, y in zip(p, q)))) for q in exact[1]]
            for p in exact[0]
        ],
        np.int64,
    ).reshape(len(a), len(b))


class Best:
    """The k best (score, id) so far of each query, and the score needed."""

    def __init__(self, ids: np.ndarray, k: int, needed: np.ndarray):
        self.ids, self.k, self.needed = ids, k, needed.astype(np.float64)
        self.rows = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        keep = (scores >= self.needed[rows]) & (found != self.ids[rows])
        if not keep.any():
            return
        rows = np.concatenate([self.rows, rows[keep]])
        scores = np.concatenate([self.scores, scores[keep]])
        found = np.concatenate([self.found, found[keep]])
        # ~score falls as the score rises, and never overflows
        order = np.lexsort((found, ~scores, rows))
        rows, scores, found = rows[order], scores[order], found[order]
        first = np.searchsorted(rows, rows)
        rank = np.arange(len(rows)) - first
        kept = rank < self.k
        self.rows, self.scores, self.found = rows[kept], scores[kept], found[kept]
        full = rank == self.k - 1
        self.needed[rows[full]] = np.maximum(self.needed[rows[full]], scores[full])


def seed_needed(queries, lengths_of_seed, seed_ids, seed, ids, k) -> np.ndarray:
    """A score that each query's k-th result reaches at least."""
    best = Best(ids, k, np.full(len(ids), -np.inf))
    scores = products(queries, seed)
    rows = np.repeat(np.arange(len(ids)), len(seed_ids))
    best.add(rows, scores.reshape(-1), np.tile(seed_ids, len(ids)))
    return best.needed


def search_group(
    best: Best, queries: np.ndarray, query_lengths: np.ndarray,
    ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray,
) -> None:
    """All candidates of a group, longest first, bucket by bucket."""
    order = np.lexsort((ids, -lengths))
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    queries, vectors = same_width(queries, vectors)
    safe = np.maximum(query_lengths, 1e-300)
    unit_queries = queries / safe[:, None]
    for at in range(0, len(ids), BUCKET):
        part = slice(at, at + BUCKET)
        longest = lengths[at]
        reach = query_lengths * longest
        active = np.flatnonzero(reach * (1 + _SLACK) + _SLACK >= best.needed)
        if not len(active):
            return  # what follows is shorter still
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach[active] > 0, best.needed[active] / reach[active], -np.inf)
        by_coordinate = active[local >= COORDINATE_FROM]
        by_length = active[local < COORDINATE_FROM]
        bucket_lengths, bucket_ids = lengths[part], ids[part]
        if len(by_length):
            shortest = best.needed[by_length] / safe[by_length] * (1 - _SLACK) - _SLACK
            count = int(np.searchsorted(-bucket_lengths, -shortest.min(), "right"))
            if count:
                scores = products(queries[by_length], vectors[part][:count])
                _keep(best, by_length, scores, bucket_ids[:count])
        if len(by_coordinate):
            unit = vectors[part] / np.maximum(bucket_lengths, 1e-300)[:, None]
            focus = np.abs(unit_queries[by_coordinate]).argmax(axis=1)
            own = unit_queries[by_coordinate, focus]
            least = np.minimum(local[local >= COORDINATE_FROM], 1.0)
            spread = np.sqrt((1 - least**2) * np.maximum(0.0, 1 - own**2))
            low = np.where(-own >= least, -1.0, own * least - spread) - 1e-7
            high = np.where(own >= least, 1.0, own * least + spread) + 1e-7
            there = unit[:, focus].T
            feasible = (there >= low[:, None]) & (there <= high[:, None])
            some = feasible.any(axis=0)
            if some.any():
                scores = products(queries[by_coordinate], vectors[part][some])
                _keep(best, by_coordinate, scores, bucket_ids[some], feasible[:, some])


def _keep(best, queries, scores, ids, allowed=None) -> None:
    enough = scores >= best.needed[queries][:, None]
    if allowed is not None:
        enough &= allowed
    rows, columns = np.nonzero(enough)
    best.add(queries[rows], scores[rows, columns], ids[columns])


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int,
    *,
    factor: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of
    each query row with the other rows.  ``is_query`` speaks of ``vec_id``."""
    rows = pin(scaled(usable(table, id_column, vector_column), factor))
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    groups = max(1, -(-total // GROUP))
    blocks = max(1, -(-asked // QUERY_BLOCK))
    # a fixed number of rows: the longest vectors
    seeds = rows.orderBy(F.desc("length"), "vec_id").limit(SEED_VECTORS).toArrow()
    seed_ids, seed = seeds["vec_id"].to_numpy(), matrix(seeds["vector"])

    ranged = pin(
        rows.repartitionByRange(groups, F.desc("length"), "vec_id").withColumn(
            "part", F.spark_partition_id()
        )
    )
    # one number per group of candidates
    reach = {r["part"]: r["longest"] for r in
             ranged.groupBy("part").agg(F.max("length").alias("longest")).collect()}
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")

    def plan(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Queries, once per group that can hold a result of theirs."""
        for batch in arriving:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids, vectors = some.column(0).to_numpy(), matrix(some.column(1))
                lengths = some.column(2).to_numpy()
                needed = seed_needed(vectors, None, seed_ids, seed, ids, k)
                for part, longest in reach.items():
                    near = np.flatnonzero(lengths * longest * (1 + _SLACK) + _SLACK >= needed)
                    if len(near):
                        chosen = some.take(pa.array(near))
                        yield {
                            "part": np.full(len(near), part, np.int32),
                            "block": chosen.column(3),
                            "vec_id": chosen.column(0),
                            "vector": chosen.column(1),
                            "length": chosen.column(2),
                            "needed": needed[near],
                        }

    queries = pin(
        through_arrow(
            rows.where(is_query).select("vec_id", "vector", "length", block),
            plan,
            "part int, block int, vec_id long, vector array<double>, length double, needed double",
        )
    )
    wanted = queries.select("part", F.col("block").alias("to_block")).distinct()
    candidates = ranged.join(wanted, "part")

    def search(key, asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or there.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        own = matrix(pa.array(asking["vector"], pa.list_(pa.float64())))
        ids = asking["vec_id"].to_numpy()
        best = Best(ids, k, asking["needed"].to_numpy())
        search_group(
            best, own, asking["length"].to_numpy(), there["vec_id"].to_numpy(),
            matrix(pa.array(there["vector"], pa.list_(pa.float64()))),
            there["length"].to_numpy(),
        )
        return pd.DataFrame(
            {"query_id": ids[best.rows], "vec_id": best.found, "score": best.scores}
        )

    found = (
        queries.groupBy("part", "block")
        .cogroup(candidates.groupBy("part", "to_block"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

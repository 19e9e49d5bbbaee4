"""Similarity join on word n-grams by MinHash banding.

The n-gram set of a text is hashed to a signature whose bands and rows are
chosen for the wanted recall at the wanted similarity: the most rows a band can
have (fewest chance meetings) within the allowed number of hashes.  Texts with
equal n-gram sets form one class and are judged once.  Classes that share a
band hash meet; there their full n-gram sets are compared, so every link given
is true.

A class is sent only to bands that bring it a pair no earlier band has brought.
A band hash that many classes share is cut into blocks, and pairs of blocks
meet in tasks of their own; inside a task links are counted and joined to
trees, never listed pair by pair.

Defined results: words are runs of anything but ASCII white space, A-Z
lower-cased; a text with fewer words than n has one n-gram of all its words; a
text without words (null and empty ones) and a row without an id have no link;
rows that share an id are one document; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from arealytics.llm.common import (
    ODD,
    WordHashes,
    groups_of,
    lower_words,
    mix,
    through_arrow,
)
from arealytics.llm.components import components
from arealytics.operators.keys import dense_index
from arealytics.session import pin

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.999
MAX_HASHES = 128
BLOCK = 256  # classes of one band hash that meet in one task, per side


def bands_and_rows(similarity: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """The largest row count, and its least band count, that find a pair of
    this similarity with this probability."""
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of hashed words."""
    if not len(words):
        return words
    size = max(1, len(words) - n + 1)
    total = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(n, len(words))):
            total = total * ODD + words[i : i + size]
    return np.unique(mix(total))


def _text_sets(texts: list[str | None], hashes: WordHashes, n: int) -> list[np.ndarray]:
    return [ngrams(hashes.of(lower_words(t)), n) for t in texts]


def signatures(
    documents: DataFrame, n: int, bands: int, rows: int, seed: int
) -> DataFrame:
    """(doc_id, digest, band hashes) of rows (doc_id, text) with words."""
    random = np.random.default_rng(seed)
    factors = random.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = random.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in arriving:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = _text_sets(some.column(1).to_pylist(), hashes, n)
                full = np.flatnonzero([len(s) > 0 for s in sets])
                if not len(full):
                    continue
                sets = [sets[i] for i in full]
                starts = np.cumsum([0, *map(len, sets)])[:-1]
                flat = np.concatenate(sets)
                least = np.empty((bands * rows, len(sets)), np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(bands * rows):
                        least[j] = np.minimum.reduceat(flat * factors[j] + offsets[j], starts)
                    keys = np.zeros((len(sets), bands), np.uint64)
                    for r in range(rows):
                        keys = mix(keys * ODD + least[r::rows].T)
                    keys = mix(keys + np.arange(bands, dtype=np.uint64))
                yield {
                    "doc_id": some.column(0).take(pa.array(full)),
                    "digest": [xxhash.xxh3_128_digest(s) for s in sets],
                    "bands": list(keys.view(np.int64)),
                }

    return through_arrow(documents, batches, "doc_id long, digest binary, bands array<long>")


def _meetings(classes: DataFrame, bands: int) -> DataFrame:
    """(bucket, band, digest, upper, lower): which class goes where.

    A band hash shared by several classes is a bucket.  It is left out where all
    its classes share an earlier band's hash too.  A bucket of more than BLOCK
    classes becomes pairs of blocks.
    """
    exploded = classes.select("digest", F.posexplode("bands").alias("band", "key"))
    shared = exploded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = exploded.join(shared, ["band", "key"])
    # what all classes of a bucket have in common before its band
    with_bands = members.join(classes, "digest")
    agree = [
        (F.min(F.col("bands")[j]) == F.max(F.col("bands")[j])) & (F.first("band") > j)
        for j in range(bands - 1)
    ]
    covered = F.lit(False)
    for a in agree:
        covered = covered | F.coalesce(a, F.lit(False))
    fresh = with_bands.groupBy("band", "key").agg(covered.alias("covered"), F.first("size").alias("size"))
    fresh = fresh.where("NOT covered").drop("covered")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    placed = members.drop("size").join(fresh, ["band", "key"]).withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("digest", F.lit(11)), F.col("blocks")).cast("int")
    placed = placed.withColumn("own", own)
    # a block meets itself and every other block once
    low = F.least("own", "other")
    high = F.greatest("own", "other")
    return placed.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        F.xxhash64("band", "key", low, high).alias("bucket"),
        "band",
        "digest",
        (F.col("own") == high).alias("upper"),
        (F.col("own") == low).alias("lower"),
    )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of slices of the 0/1 matrices
    over the n-grams that both sides have."""
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(flat_l, flat_r)
    found = np.zeros((len(left), len(right)), np.float32)
    row_l = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_r = np.repeat(np.arange(len(right)), [len(s) for s in right])
    for at in range(0, len(both), 4096):
        part = both[at : at + 4096]
        sides = []
        for flat, row, count in ((flat_l, row_l, len(left)), (flat_r, row_r, len(right))):
            column = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            there = part[column] == flat
            dense = np.zeros((count, len(part)), np.float32)
            dense[row[there], column[there]] = 1
            sides.append(dense)
        found += sides[0] @ sides[1].T
    return found


def _link_block(left, right, same: bool, band: int, similarity: float):
    """Linked pairs (rows of left, rows of right) that no earlier band brought
    together.  A side is (ids, sets, bands)."""
    ids_l, sets_l, bands_l = left
    ids_r, sets_r, bands_r = right
    shared = _overlaps(sets_l, sets_r)
    sizes_l = np.array([len(s) for s in sets_l])[:, None]
    sizes_r = np.array([len(s) for s in sets_r])[None, :]
    # as integers, so that exactly the wanted similarity counts
    linked = shared >= similarity * (sizes_l + sizes_r - shared) - 1e-9
    linked &= ids_l[:, None] != ids_r[None, :]
    if same:
        linked &= np.arange(len(ids_l))[:, None] < np.arange(len(ids_r))[None, :]
    for j in range(band):
        linked &= bands_l[:, j][:, None] != bands_r[:, j][None, :]
    return np.nonzero(linked)


def _tree(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept: tuple[list[int], list[int]] = ([], [])
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept[0].append(x)
            kept[1].append(y)
    return kept


def links(
    documents: DataFrame,
    meetings: DataFrame,
    classes: DataFrame,
    n: int,
    similarity: float,
) -> DataFrame:
    """(a, b, documents): with b, an edge of a spanning forest; without, the
    number of documents in classes linked to class a."""
    named = classes.select("class_id", "digest", "bands", "size")
    # only classes that meet another need their texts again
    wanted = named.join(meetings.select("digest").distinct(), "digest", "left_semi")
    texts = wanted.join(documents, wanted["class_id"] == documents["doc_id"]).select(
        "class_id", "digest", "bands", "size", "text"
    )

    def sets(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in arriving:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = _text_sets(some.column(4).to_pylist(), hashes, n)
                digests = some.column(1).to_pylist()
                right = [
                    i for i, s in enumerate(found)
                    if len(s) and xxhash.xxh3_128_digest(s) == digests[i]
                ]
                chosen = some.take(pa.array(right, pa.int64()))
                yield {
                    "class_id": chosen.column(0),
                    "digest": chosen.column(1),
                    "bands": chosen.column(2),
                    "size": chosen.column(3),
                    "grams": [found[i].tobytes() for i in right],
                }

    full = through_arrow(
        texts, sets, "class_id long, digest binary, bands array<long>, size long, grams binary"
    )
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        meetings.join(full, "digest")
        .select(
            "bucket", "band", "class_id", "digest", "upper", "lower", "bands", "size", "grams"
        )
        .repartition(width, "bucket")
        .sortWithinPartitions("bucket")
    )

    def compare(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, group in groups_of(arriving, "bucket"):
            # an id that several rows share brings its text several times
            place = {d: i for i, d in enumerate(group["digest"].to_pylist())}
            if len(place) < 2:
                continue
            if len(place) < group.num_rows:
                group = group.take(pa.array(sorted(place.values())))
            ids = group["class_id"].to_numpy()
            grams = [np.frombuffer(g, np.uint64) for g in group["grams"].to_pylist()]
            bands = np.array(group["bands"].to_pylist(), np.int64)
            sizes = group["size"].to_numpy()
            band = group["band"][0].as_py()
            upper = np.flatnonzero(group["upper"].to_numpy())
            lower = np.flatnonzero(group["lower"].to_numpy())
            same = len(upper) == len(ids) and len(lower) == len(ids)

            def side(rows):
                return ids[rows], [grams[i] for i in rows], bands[rows]

            if not len(upper) or not len(lower):
                continue
            a, b = _link_block(side(lower), side(upper), same, band, similarity)
            if not len(a):
                continue
            a, b = lower[a], upper[b]
            counts = np.bincount(a, sizes[b], len(ids)) + np.bincount(b, sizes[a], len(ids))
            some = np.flatnonzero(counts)
            yield {
                "a": ids[some],
                "b": pa.nulls(len(some), pa.int64()),
                "documents": counts[some].astype(np.int64),
            }
            x, y = _tree(ids[a], ids[b])
            yield {"a": x, "b": y, "documents": pa.nulls(len(x), pa.int64())}

    return through_arrow(dealt, compare, "a long, b long, documents long")


def similar_documents(
    documents: DataFrame,
    *,
    n: int = NGRAM,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    seed: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, copy_of (smallest id with the same n-gram
    set), class_id (smallest id of all documents linked directly or through
    others) and n_links (other documents at least as similar as asked)."""
    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    bands, height = bands_and_rows(similarity, recall)
    signed = pin(
        signatures(rows.where("doc_id IS NOT NULL"), n, bands, height, seed)
    )
    by_set = signed.groupBy("digest").agg(
        F.min("doc_id").alias("class_id"),
        F.count_distinct("doc_id").alias("size"),
        F.min("bands").alias("bands"),
    )
    classes = pin(by_set)
    meetings = pin(_meetings(classes.select("digest", "bands"), bands))
    found = pin(links(rows, meetings, classes, n, similarity))
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("documents").alias("linked"))
    of_class = (
        classes.drop("bands").join(groups, F.col("class_id") == F.col("node"), "left")
        .join(counts, F.col("class_id") == F.col("a"), "left")
        .select(
            "digest",
            F.col("class_id").alias("copy_of"),
            F.coalesce("component", "class_id").alias("class_id"),
            F.coalesce("linked", F.lit(0)).alias("linked"),
            (F.col("size") - 1).alias("copies"),
        )
    )
    # an id with several texts can name several classes at once: its links count once
    by_name = F.collect_set(F.struct("copy_of", "linked"))
    linked = F.aggregate(by_name, F.lit(0).cast("long"), lambda n, x: n + x["linked"])
    judged = (
        signed.select("doc_id", "digest").distinct().join(of_class, "digest")
        .groupBy("doc_id")
        .agg(F.min("copy_of").alias("copy_of"), F.min("class_id").alias("class_id"),
             (linked + F.sum("copies")).alias("n_links"))
    )
    return rows.select("doc_id").join(judged, "doc_id", "left").select(
        "doc_id",
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The documents that remain when one of each group of similar documents
    stays, the one with the smallest id; rows without words or id stay.

    Rows that share an id are judged by their texts, each for itself, and the
    smaller text hash goes first; of rows with the same id and text one stays.
    """
    fields = [f.name for f in documents.schema.fields]
    rows = documents.select(
        F.struct(*[documents[f] for f in fields]).alias("row"),
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    named = rows.where("doc_id IS NOT NULL")
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        # every (id, text) gets a number of its own, in the order of the ids
        hashes = {"_a": F.xxhash64("text"), "_b": F.xxhash64(F.lit(1), F.col("text"))}
        numbered = dense_index(named.withColumns(hashes), ["doc_id", "_a", "_b"], "_number")
        named = pin(numbered.withColumnRenamed("_number", "doc_id")).dropDuplicates(["doc_id"])
    judged = similar_documents(named, **options)
    going = judged.where("doc_id <> class_id").select("doc_id").distinct()
    left = named.join(going, "doc_id", "left_anti").select("row")
    return left.unionByName(rows.where("doc_id IS NULL").select("row")).select("row.*")

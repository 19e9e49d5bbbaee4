"""Merkle manifest of a dataset, its leaf places found by ranked bitmaps.

Every row is a leaf.  The leaves of a source ascend by id and are hashed three
by three, level by level, into the source's subroot; the subroots, in the order
of the sources, likewise into the root.  A leaf's proof are the siblings on its
way to the root.

A leaf's place is the number of ids below its own in its source.  It is not
found by sorting leaves: tasks gather the ids of a source into compressed
bitmaps, one per 65,536 neighbouring ids (a list of the low halves while there
are few, bits when there are many), the bitmaps of all tasks are merged, and a
popcount directory of three levels tells how many ids lie before a bitmap, each
level summing at most 65,536 entries.  A rank query is then the directory's
entry plus the set bits below the id.  Ids that occur more than once carry a
surplus next to the bitmap.

Levels are reduced by keyed slot arrays: an array holds the 3 ** 8 nodes under
one node eight levels up, each put into the slot that its place names.  Packed
arrays are stored, so a tree of any height needs one shuffle per eight levels,
and proofs are read from them from the top down.  No task holds a source: a
source with a third of all rows is as many arrays as its rows fill.

Defined results: a null id stands before all others of its source; rows of one
id stand in the order of their leaf digests, equal rows next to each other, each
with its own place; a null source is the first source; a null text is the field
``-``, other than an empty text; a lone leaf is its own root and its proof is
the digest of nothing; an empty table gives no rows; columns other than the five
named are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arealytics.llm.common import arrow_schema, through_arrow
from arealytics.operators.joins import lookup_join, shuffle_width
from arealytics.operators.keys import in_ranges, with_offset
from arealytics.session import pin

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
LEVELS = 8  # of one array, which has FANOUT ** LEVELS slots
LOW_BITS = 16
DENSE = 4096  # ids of a bitmap stored as bits; fewer are a list
NULL_HIGH = -(1 << 47) - 1  # below the upper part of every id
BUCKET_ROWS = 100_000
COPIES = 4096  # equal rows put out by one list
FIRST = Window.unboundedPreceding


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """The leaf digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def without_line_breaks(tampered: Column, columns=COLUMNS) -> Column:
    """The leaf of rows whose text has lost its line breaks where ``tampered``."""
    *others, text = columns
    changed = F.when(tampered, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))
    return leaf(*map(F.col, others), changed)


# ---- sources -------------------------------------------------------------


def _number_sources(leaves: DataFrame) -> DataFrame:
    """``sid``: 0 for the null source, the others from 1 by their bytes."""
    named = leaves.where(F.col("source").isNotNull()).select("source").distinct()
    numbered = pin(
        with_offset(in_ranges(named, ["source"]), F.count(F.lit(1))).select(
            "source", (F.col("_offset") + F.col("_place") + 1).alias("sid")
        )
    )
    return lookup_join(leaves, numbered, ["source"]).withColumn(
        "sid", F.coalesce("sid", F.lit(0).cast("long"))
    ).drop("source")


# ---- bitmaps -------------------------------------------------------------

_CONTAINER = "sid long, high long, ids long, rows long, lows binary, repeated binary, surplus binary"


def _high() -> Column:
    return F.coalesce(F.shiftright("doc_id", LOW_BITS), F.lit(NULL_HIGH))


def _low() -> Column:
    return F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << LOW_BITS) - 1)), F.lit(0)).cast("int")


def _encoded(lows: np.ndarray) -> bytes:
    """Different low halves: a list while few, bits beyond."""
    if len(lows) < DENSE:
        return np.sort(lows).astype(np.uint16).tobytes()
    bits = np.zeros(1 << LOW_BITS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _decoded(ids: int, lows: bytes) -> np.ndarray:
    if ids < DENSE:
        return np.frombuffer(lows, np.uint16)
    return np.flatnonzero(np.unpackbits(np.frombuffer(lows, np.uint8), bitorder="little"))


def _containers_of(sid, high, low, count) -> dict[str, list]:
    """One container per (sid, high) of different (sid, high, low)."""
    at = pd.DataFrame({"sid": sid, "high": high})
    group = at.groupby(["sid", "high"], sort=False)
    found: dict[str, list] = {f.split()[0]: [] for f in _CONTAINER.split(", ")}
    for (one_sid, one_high), rows in group.indices.items():
        n = count[rows]
        again = rows[n > 1]
        found["sid"].append(int(one_sid))
        found["high"].append(int(one_high))
        found["ids"].append(len(rows))
        found["rows"].append(int(n.sum()))
        found["lows"].append(_encoded(low[rows]))
        found["repeated"].append(low[again].astype(np.uint16).tobytes())
        found["surplus"].append((count[again] - 1).astype(np.int64).tobytes())
    return found


def _bucket(*columns: str, rows: int, width: int) -> Column:
    count = max(width, -(-rows // BUCKET_ROWS))
    return F.pmod(F.xxhash64(*columns), F.lit(count)).cast("int")


def containers(ids: DataFrame, rows: int) -> DataFrame:
    """Merged bitmaps of (sid, doc_id, n), one row per (sid, high)."""
    schema = _arrow(_CONTAINER)

    def gather(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in arriving:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 20:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def flush(held: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(held)
        return _containers_of(*(table[c].to_numpy() for c in ("sid", "high", "low", "n")))

    def merge(table: pa.Table) -> pa.Table:
        parts = table.to_pydict()
        low, count, sizes = [], [], []
        for n, lows, again, more in zip(*(parts[c] for c in ("ids", "lows", "repeated", "surplus"))):
            some = _decoded(n, lows).astype(np.int64)
            times = np.ones(len(some), np.int64)
            again = np.frombuffer(again, np.uint16)
            # the low halves of a part ascend
            order = np.searchsorted(some, again)
            times[order] += np.frombuffer(more, np.int64)
            low.append(some)
            count.append(times)
            sizes.append(n)
        whole = _containers_of(
            np.repeat(parts["sid"], sizes), np.repeat(parts["high"], sizes),
            np.concatenate(low), np.concatenate(count),
        )
        return pa.table(whole, schema=schema)

    parts = through_arrow(ids.select("sid", _high().alias("high"), _low().alias("low"), "n"), gather, _CONTAINER)
    width = shuffle_width(ids)
    dealt = parts.withColumn("bucket", _bucket("sid", "high", rows=rows, width=width))
    return dealt.groupBy("bucket").applyInArrow(
        lambda table: merge(table.drop_columns("bucket")), _CONTAINER
    )


def _arrow(schema: str) -> pa.Schema:
    return pa.schema(list(zip(*arrow_schema(schema))))


def directory(merged: DataFrame) -> DataFrame:
    """(sid, high, before): rows of the source before each bitmap.  Three
    levels of sums; a window never covers more than 65,536 entries (and one for
    null ids)."""

    def below(table: DataFrame, entry: str, group: list[str], name: str) -> DataFrame:
        window = Window.partitionBy("sid", *group).orderBy(entry).rowsBetween(FIRST, -1)
        return table.withColumn(name, F.coalesce(F.sum("rows").over(window), F.lit(0)))

    first = merged.select("sid", "high", "rows").withColumns({
        "middle": F.shiftright("high", LOW_BITS), "top": F.shiftright("high", 2 * LOW_BITS),
    })
    second = first.groupBy("sid", "top", "middle").agg(F.sum("rows").alias("rows"))
    third = second.groupBy("sid", "top").agg(F.sum("rows").alias("rows"))
    return (
        below(first, "high", ["middle"], "_a").drop("rows")
        .join(below(second, "middle", ["top"], "_b").drop("rows"), ["sid", "top", "middle"])
        .join(below(third, "top", [], "_c").drop("rows"), ["sid", "top"])
        .select("sid", "high", (F.col("_a") + F.col("_b") + F.col("_c")).alias("before"))
    )


def ranks(container: np.ndarray, low: np.ndarray, ids: list[int], lows: list[bytes],
          repeated: list[bytes], surplus: list[bytes]) -> np.ndarray:
    """Rows below ``low`` within the given containers."""
    found = np.zeros(len(low), np.int64)
    dense = np.flatnonzero(np.asarray(ids) >= DENSE)
    if len(dense):
        words = np.frombuffer(b"".join(lows[i] for i in dense), np.uint64).reshape(len(dense), -1)
        counts = np.bitwise_count(words).astype(np.int64)
        popcounts = np.cumsum(counts, axis=1) - counts
        place = np.full(len(ids), -1)
        place[dense] = np.arange(len(dense))
        rows = np.flatnonzero(place[container] >= 0)
        at, word = place[container[rows]], low[rows] >> 6
        below = (np.uint64(1) << (low[rows] & 63).astype(np.uint64)) - np.uint64(1)
        found[rows] = popcounts[at, word] + np.bitwise_count(words[at, word] & below)
    _add_listed(found, container, low, [b"" if n >= DENSE else b for n, b in zip(ids, lows)], None)
    _add_listed(found, container, low, repeated, surplus)
    return found


def _add_listed(found, container, low, listed: list[bytes], weights: list[bytes] | None) -> None:
    sizes = np.array([len(b) // 2 for b in listed])
    if not sizes.sum():
        return
    keys = np.frombuffer(b"".join(listed), np.uint16).astype(np.int64)
    keys += np.repeat(np.arange(len(listed)), sizes) << LOW_BITS
    amounts = np.ones(len(keys), np.int64) if weights is None else np.frombuffer(b"".join(weights), np.int64)
    order = np.argsort(keys, kind="stable")
    upto = np.concatenate([[0], np.cumsum(amounts[order])])
    keys = keys[order]
    wanted = (container.astype(np.int64) << LOW_BITS) + low
    start = container.astype(np.int64) << LOW_BITS
    found += upto[np.searchsorted(keys, wanted)] - upto[np.searchsorted(keys, start)]


_RANKED = "sid long, doc_id long, leaf binary, claim binary, place long"


def place_of(rows: DataFrame, merged: DataFrame, total: int) -> DataFrame:
    """(sid, doc_id, leaf, claim) with ``place``, the rows of the source whose
    ids are smaller; at most 65,536 rows ask the same bitmap."""
    width = shuffle_width(rows)
    bucket = _bucket("sid", "high", rows=total, width=width)
    asking = rows.select("sid", "doc_id", "leaf", "claim", _high().alias("high"), _low().alias("low"))
    told = merged.join(directory(merged), ["sid", "high"]).withColumn("bucket", bucket)
    schema = _arrow(_RANKED)

    def answer(asked: pa.Table, maps: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return schema.empty_table()
        keys = pd.DataFrame({c: maps[c].to_numpy() for c in ("sid", "high", "before")})
        keys["container"] = np.arange(len(keys))
        wanted = pd.DataFrame({c: asked[c].to_numpy() for c in ("sid", "high")})
        met = wanted.merge(keys, on=["sid", "high"], how="left", validate="many_to_one")
        within = ranks(
            met["container"].to_numpy(), asked["low"].to_numpy().astype(np.int64),
            *(maps[c].to_pylist() for c in ("ids", "lows", "repeated", "surplus")),
        )
        place = pa.array(met["before"].to_numpy() + within)
        return asked.select(["sid", "doc_id", "leaf", "claim"]).append_column("place", place).cast(schema)

    return (
        asking.withColumn("bucket", bucket).groupBy("bucket")
        .cogroup(told.groupBy("bucket")).applyInArrow(answer, _RANKED)
    )


def leaf_places(leaves: DataFrame) -> DataFrame:
    """``place`` for every leaf (sid, doc_id, leaf, claim) of its source."""
    ids = pin(leaves.groupBy("sid", "doc_id").agg(F.count(F.lit(1)).alias("n")))
    total, again = ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 1, 1))
    ).first()
    merged = pin(containers(ids, total))
    if not again:
        return place_of(leaves, merged, total)

    # a repeated id is ranked once; its rows follow each other by digest
    repeated = pin(ids.where("n > 1").withColumn("_id", _identity()))
    known = lookup_join(
        leaves.withColumn("_id", _identity()), repeated.select("sid", "_id", "n"), ["sid", "_id"]
    )
    nothing = F.lit(None).cast("binary")
    asked = known.where("n IS NULL").select("sid", "doc_id", "leaf", "claim").unionByName(
        repeated.select("sid", "doc_id", nothing.alias("leaf"), nothing.alias("claim"))
    )
    placed = pin(place_of(asked, merged, total))
    alike = (
        known.where("n IS NOT NULL").groupBy("sid", "_id", "doc_id", "leaf", "claim")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    starts = placed.where("leaf IS NULL").select(
        "sid", _identity().alias("_id"), F.col("place").alias("_start")
    )
    order = ["sid", "_id", "leaf", "claim"]
    ranged = pin(with_offset(in_ranges(alike, order), F.sum("n")))
    before = Window.partitionBy("_part").orderBy("_place").rowsBetween(FIRST, -1)
    running = pin(ranged.withColumn(
        "_running", F.col("_offset") + F.coalesce(F.sum("n").over(before), F.lit(0))
    ))
    first = running.groupBy("sid", "_id").agg(F.min("_running").alias("_first")).join(starts, ["sid", "_id"])
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))
    within = F.sequence(
        F.col("_piece") * COPIES, F.least(F.col("n"), (F.col("_piece") + 1) * COPIES) - 1
    )
    several = (
        lookup_join(running, first, ["sid", "_id"], "inner")
        .withColumn("_piece", pieces).withColumn("_copy", F.explode(within))
        .select("sid", "doc_id", "leaf", "claim",
                (F.col("_start") + F.col("_running") - F.col("_first") + F.col("_copy")).alias("place"))
    )
    return placed.where("leaf IS NOT NULL").unionByName(several)


def _identity() -> Column:
    """The id as text, below all others for null."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


# ---- slot arrays -----------------------------------------------------------


def _join(parts: list[bytes]) -> bytes:
    """H of digests as hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def reduce_slots(nodes: list[bytes], whole: bool, most: int = LEVELS) -> list[list[bytes]]:
    """All levels above ``nodes``: up to the one node left of a whole tree, or
    exactly ``most`` of them."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= most:
        last = levels[-1]
        levels.append([_join(last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return levels


def path_of(levels: list[list[bytes]], slot: int) -> bytes:
    """Siblings level by level: one byte (place and size of the run), then the
    other digests of the run."""
    steps = []
    for nodes in levels[:-1]:
        start = slot - slot % FANOUT
        run = nodes[start : start + FANOUT]
        steps.append(bytes([slot % FANOUT << 4 | len(run)]))
        steps += run[: slot - start] + run[slot - start + 1 :]
        slot //= FANOUT
    return b"".join(steps)


def siblings(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place, other digests) of every level of a path."""
    at = 0
    while at < len(path):
        place, size = path[at] >> 4, path[at] & 15
        yield place, [path[at + 1 + 32 * i : at + 33 + 32 * i] for i in range(size - 1)]
        at += 1 + 32 * (size - 1)


def fold(digest: bytes, steps: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, others in steps:
        digest = _join([*others[:place], digest, *others[place:]])
    return digest


_ARRAY = "sid long, block long, ids array<long>, slots binary, claimed binary, claims binary, root binary"


def slot_arrays(nodes: DataFrame, total: int, most: int = LEVELS) -> DataFrame:
    """Packed arrays of nodes (sid, place, doc_id, leaf, claim) and their roots."""
    span = FANOUT**most
    schema = _arrow(_ARRAY)

    def pack(table: pa.Table) -> pa.Table:
        sid, block, slot = (table[c].to_numpy() for c in ("sid", "block", "slot"))
        ids, leaves, claims = (table[c].to_pylist() for c in ("doc_id", "leaf", "claim"))
        found: dict[str, list] = {n: [] for n in schema.names}
        groups = pd.DataFrame({"sid": sid, "block": block}).groupby(["sid", "block"], sort=False)
        for (one_sid, one_block), rows in groups.indices.items():
            array: list = [None] * len(rows)
            names: list = [None] * len(rows)
            other = []
            for row in rows.tolist():
                at = slot[row]
                array[at], names[at] = leaves[row], ids[row]
                if claims[row] is not None and claims[row] != leaves[row]:
                    other.append((at, claims[row]))
            # only the first array of a tree can be the whole tree
            root = reduce_slots(array, one_block == 0, most)[-1][0]
            values = (
                int(one_sid), int(one_block), names, b"".join(array),
                np.array([a for a, _ in other], np.uint16).tobytes(), b"".join(c for _, c in other), root,
            )
            for name, value in zip(schema.names, values):
                found[name].append(value)
        return pa.table(found, schema=schema)

    dealt = nodes.select(
        "sid", F.expr(f"place div {span}").alias("block"),
        (F.col("place") % span).cast("int").alias("slot"), "doc_id", "leaf", "claim",
    ).withColumn("bucket", _bucket("sid", "block", rows=total, width=shuffle_width(nodes)))
    return dealt.groupBy("bucket").applyInArrow(pack, _ARRAY)


def _upward(nodes: DataFrame, total: int, most: int) -> list[DataFrame]:
    """Arrays of arrays until every tree is one array."""
    nothing = F.lit(None)
    stages = [pin(slot_arrays(nodes, total, most))]
    while _highest(stages[-1]) > 0:
        last = stages[-1]
        total = last.count()
        stages.append(pin(slot_arrays(last.select(
            "sid", F.col("block").alias("place"), nothing.cast("long").alias("doc_id"),
            F.col("root").alias("leaf"), nothing.cast("binary").alias("claim"),
        ), total, most)))
    return stages


def _highest(stage: DataFrame) -> int:
    return stage.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]


_BELOW = "sid long, block long, path binary, subroot binary, root binary"
_PROVED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _unpacked(batch: pa.RecordBatch, most: int) -> Iterator[tuple[dict, list[list[bytes]]]]:
    for row in batch.to_pylist():
        slots = row["slots"]
        nodes = [slots[i : i + 32] for i in range(0, len(slots), 32)]
        yield row, reduce_slots(nodes, row["block"] == 0, most)


def _paths(arrays: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """What lies above the arrays one stage below."""
    span = FANOUT**most

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            for row, levels in _unpacked(batch, most):
                slots = len(levels[0])
                yield {
                    "sid": [row["sid"]] * slots,
                    "block": np.arange(slots) + row["block"] * span,
                    "path": [path_of(levels, s) + row["path"] for s in range(slots)],
                    "subroot": [row["subroot"]] * slots,
                    "root": [row["root"]] * slots,
                }

    return through_arrow(_with_above(arrays, above), batches, _BELOW)


def _with_above(arrays: DataFrame, above: DataFrame) -> DataFrame:
    return arrays.drop("root").join(above, ["sid", "block"]).select(
        "sid", "block", "ids", "slots", "claimed", "claims", "path", "subroot", "root"
    )


def _proofs(arrays: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """The answer for every leaf of the lowest arrays."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in arriving:
            for row, levels in _unpacked(batch, most):
                upper = list(siblings(row["path"]))
                upper_text = b"".join(d for _, others in upper for d in others).hex()
                claims = dict(zip(
                    np.frombuffer(row["claimed"], np.uint16).tolist(),
                    (row["claims"][i : i + 32] for i in range(0, len(row["claims"]), 32)),
                ))
                proofs, folded = [], []
                for slot, node in enumerate(levels[0]):
                    lower = list(siblings(path_of(levels, slot)))
                    text = b"".join(d for _, others in lower for d in others).hex()
                    proofs.append(hashlib.sha256((text + upper_text).encode()).hexdigest())
                    folded.append(fold(claims.get(slot, node), lower + upper))
                slots = len(levels[0])
                yield {
                    "doc_id": row["ids"],
                    "leaf": [n.hex() for n in levels[0]],
                    "subroot": [row["subroot"].hex()] * slots,
                    "root": [row["root"].hex()] * slots,
                    "proof_sha256": proofs,
                    "folded_root": [f.hex() for f in folded],
                    "verified": [f == row["root"] for f in folded],
                }

    return through_arrow(_with_above(arrays, above), batches, _PROVED)


def prove(leaves: DataFrame, most: int = LEVELS) -> DataFrame:
    """Leaf, subroot, root, proof digest and check of every row (doc_id, source,
    leaf, claim).  ``claim`` is the leaf digest to be checked against the
    manifest of the leaves; null stands for the leaf itself."""
    numbered = pin(_number_sources(leaves))
    total = numbered.count()
    stages = _upward(leaf_places(numbered), total, most)
    tops = stages[-1].select("sid", F.col("root").alias("subroot"))
    # without a null source the first source has number 1
    lowest, sources = tops.agg(F.coalesce(F.min("sid"), F.lit(0)), F.count(F.lit(1))).first()
    of_sources = _upward(
        tops.select(
            F.lit(-1).cast("long").alias("sid"), (F.col("sid") - lowest).alias("place"),
            F.lit(None).cast("long").alias("doc_id"), F.col("subroot").alias("leaf"),
            F.lit(None).cast("binary").alias("claim"),
        ), sources, most,
    )
    above = of_sources[-1].select(
        "sid", "block", F.unhex(F.lit("")).alias("path"), F.col("root").alias("subroot"), "root"
    )
    for arrays in reversed(of_sources):
        above = _paths(arrays, above, most)
    above = tops.join(above.select((F.col("block") + lowest).alias("sid"), "path", "root"), "sid").select(
        "sid", F.lit(0).cast("long").alias("block"), "path", "subroot", "root"
    )
    for arrays in reversed(stages[1:]):
        above = _paths(arrays, above, most)
    return _proofs(stages[0], above, most)


def manifest(
    documents: DataFrame, tampered: Column | None = None, columns=COLUMNS, most: int = LEVELS
) -> DataFrame:
    """Proofs of all documents, checked against texts that lost their line
    breaks where ``tampered`` holds."""
    rows = documents.select(*[documents[c].alias(c) for c in columns])
    claim = without_line_breaks(tampered, columns) if tampered is not None else F.lit(None).cast("binary")
    return prove(rows.select(
        rows[columns[0]].cast("long").alias("doc_id"), rows[columns[1]].cast("string").alias("source"),
        leaf(*[rows[c] for c in columns]).alias("leaf"), claim.alias("claim"),
    ), most)


#: crc32 of the decimal id, bit by bit; the rest follows the levels of the tree.
MERKLE_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
    [coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
     coalesce(strlen(source) || ':' || source, '-'),
     coalesce(strlen(lang) || ':' || lang, '-'),
     coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')] AS head,
    4294967295 - list_reduce(
      list_prepend(4294967295::BIGINT, [ord(c)::BIGINT for c in string_split(coalesce(doc_id::VARCHAR, ''), '')
                                        if c <> '']),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0::BIGINT for i in range(8)]),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
    ) AS crc
  FROM documents
), claimed AS (
  SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM fields
), leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source,
    sha256(array_to_string(head, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(array_to_string(head, '') || coalesce(strlen(other) || ':' || other, '-')) AS claim
  FROM claimed
), places AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS place
  FROM leaves
), tree AS (
  SELECT 0 AS level, source, place, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM places
  UNION ALL
  SELECT level + 1, source, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM tree WHERE n > 1 GROUP BY level, source, place // 3
), subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM tree WHERE n = 1
), upper_tree AS (
  SELECT 0 AS level, place, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM upper_tree WHERE n > 1 GROUP BY level, place // 3
), climbed AS (
  SELECT id, source, 0 AS level, place, claim AS folded, ''::VARCHAR AS proof FROM places
  UNION ALL
  SELECT c.id, any_value(c.source), c.level + 1, c.place // 3,
    sha256(string_agg(CASE WHEN t.place = c.place THEN c.folded ELSE t.h END, '' ORDER BY t.place)),
    any_value(c.proof) || coalesce(string_agg(t.h, '' ORDER BY t.place) FILTER (WHERE t.place <> c.place), '')
  FROM climbed c JOIN tree t ON t.source IS NOT DISTINCT FROM c.source AND t.level = c.level
    AND t.place // 3 = c.place // 3 AND t.n > 1
  GROUP BY c.id, c.level, c.place
), at_subroot AS (
  SELECT id, source, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof
  FROM climbed GROUP BY id, source
), above AS (
  SELECT a.id, 0 AS level, s.place, a.folded, a.proof
  FROM at_subroot a JOIN subroots s ON s.source IS NOT DISTINCT FROM a.source
  UNION ALL
  SELECT c.id, c.level + 1, c.place // 3,
    sha256(string_agg(CASE WHEN t.place = c.place THEN c.folded ELSE t.h END, '' ORDER BY t.place)),
    any_value(c.proof) || coalesce(string_agg(t.h, '' ORDER BY t.place) FILTER (WHERE t.place <> c.place), '')
  FROM above c JOIN upper_tree t ON t.level = c.level AND t.place // 3 = c.place // 3 AND t.n > 1
  GROUP BY c.id, c.level, c.place
), ended AS (
  SELECT id, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM above GROUP BY id
)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, sha256(e.proof) AS proof_sha256,
  e.folded AS folded_root, e.folded = r.h AS verified
FROM places p JOIN ended e USING (id)
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
CROSS JOIN (SELECT h FROM upper_tree WHERE n = 1) r
"""

"""What several operators share: splits, tokens, hashes, packed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Fixed value: a word is a run of anything but ASCII white space.  Python's
#: ``bytes.split()`` cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts can be long: what travels between Spark and Python at once is small.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

END_WORD = np.uint64(0x9E3779B97F4A7C15)  # stands for the end of a text
BEGIN_WORD = np.uint64(0xC2B2AE3D27D4EB4F)  # the place before the first word
ODD = np.uint64(0xD6E8FEB86659FD93)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as ''."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus)).cast("int")


def through_arrow(
    df: DataFrame,
    batches: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` for a function that yields columns as plain dicts."""
    names, kinds = arrow_schema(schema)
    for setting, value in ARROW_SETTINGS.items():
        df.sparkSession.conf.set(setting, value)

    def run(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in batches(arriving):
            yield pa.RecordBatch.from_arrays(
                [
                    columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n], k)
                    for n, k in zip(names, kinds)
                ],
                names=names,
            )

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str | StructType) -> tuple[list[str], list[pa.DataType]]:
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembering the commonest in bounded space."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8; none for null."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple]:
    """(key, table) for each run of equal keys in rows sorted by ``key``; one
    group is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if not len(values):
            continue
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        starts = [0, *cuts.tolist(), len(values)]
        for a, b in zip(starts, starts[1:]):
            if held and values[a] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = values[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)

"""Rows of vectors: which take part, one per id, and packed blocks of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of rows that have an id and only finite components.  A
    row is named by its id: of rows that share one the smallest vector counts."""
    vector = rows[vector_column].cast("array<double>")
    return (
        rows.select(rows[id_column].cast("long").alias("vec_id"), vector.alias("vector"))
        .where(
            "vec_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL "
            "OR isnan(x) OR abs(x) = double('infinity'))"
        )
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(sizes):
        return np.zeros((0, 0))
    width = int(sizes.max())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    filled = np.zeros((len(sizes), width))
    filled[np.arange(width) < sizes[:, None]] = flat
    return filled


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(
        x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))
        for x in (a, b)
    )


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] if values.ndim > 1 else 0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

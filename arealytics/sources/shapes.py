"""Polygons from geo-parquet (WKB) and GeoJSON into ``rings`` columns."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from arealytics.operators.geometry import RINGS_TYPE

_POLYGON, _MULTIPOLYGON = 3, 6
_Z, _M, _SRID = 0x80000000, 0x40000000, 0x20000000


def _polygons(buffer: bytes, at: int = 0) -> tuple[list[list[np.ndarray]], int]:
    """Polygons of one WKB value, each a list of (n, 2) ring arrays."""
    order = "<" if buffer[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", buffer, at + 1)
    at += 5
    if code & _SRID:
        at += 4
    iso = code & 0x1FFFFFFF
    width = 2 + bool(code & _Z) + bool(code & _M) + (0, 1, 1, 2)[iso // 1000]
    kind = iso % 1000
    (count,) = struct.unpack_from(order + "I", buffer, at)
    at += 4
    if kind == _MULTIPOLYGON:
        parts = []
        for _ in range(count):
            inner, at = _polygons(buffer, at)
            parts += inner
        return parts, at
    if kind != _POLYGON:
        raise ValueError(f"not a polygon: geometry type {kind}")
    rings = []
    for _ in range(count):
        (points,) = struct.unpack_from(order + "I", buffer, at)
        at += 4
        values = np.frombuffer(buffer, order + "f8", points * width, at)
        rings.append(values.reshape(points, width)[:, :2])
        at += 8 * points * width
    return [rings], at


def _rings_array(values: Sequence[bytes | None]) -> pa.Array:
    """One Arrow ``rings`` array for a batch, built from flat coordinates."""
    points: list[np.ndarray] = []
    holes: list[bool] = []
    ring_ends = [0]
    shape_ends = [0]
    for value in values:
        for polygon in _polygons(value)[0] if value is not None else []:
            for position, ring in enumerate(polygon):
                points.append(ring)
                holes.append(position > 0)
                ring_ends.append(ring_ends[-1] + len(ring))
        shape_ends.append(len(holes))
    flat = np.concatenate(points).astype("f8") if points else np.empty((0, 2))
    xy = pa.StructArray.from_arrays(
        [pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], ["x", "y"]
    )
    ring = pa.StructArray.from_arrays(
        [
            pa.array(holes, pa.bool_()),
            pa.ListArray.from_arrays(pa.array(ring_ends, pa.int32()), xy),
        ],
        ["hole", "points"],
    )
    return pa.ListArray.from_arrays(pa.array(shape_ends, pa.int32()), ring)


def decode_wkb(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Replace a WKB column by ``rings``; Arrow batches, one pass."""
    keep = [c for c in df.columns if c != geometry]
    schema = T.StructType([df.schema[c] for c in keep]).add(
        "rings", T.DataType.fromDDL(RINGS_TYPE)
    )

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = _rings_array(batch.column(geometry).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], rings], [*keep, "rings"]
            )

    return df.mapInArrow(decode, schema)


def read_shapes(
    spark: SparkSession, path: str, columns: Sequence[str], geometry: str = "geometry"
) -> DataFrame:
    """Geo-parquet: the named attribute columns and ``rings``."""
    return decode_wkb(spark.read.parquet(path).select(*columns, geometry), geometry)


def _ring(points: Column, hole: Column) -> Column:
    return F.struct(
        hole.alias("hole"),
        F.transform(
            points,
            lambda p: F.struct(
                F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")
            ),
        ).alias("points"),
    )


def _polygon_rings(polygon: Column) -> Column:
    return F.transform(polygon, lambda ring, i: _ring(ring, i > 0))


def geojson_rings(kind: Column, coordinates: Column) -> Column:
    """``rings`` from a geometry's type and its raw coordinates text."""
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    several = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", _polygon_rings(polygon)).when(
        kind == "MultiPolygon", F.flatten(F.transform(several, _polygon_rings))
    )


_FEATURE = "properties:map<string,string>,geometry:struct<type:string,coordinates:string>"


def _split_features(spark: SparkSession, path: str) -> DataFrame:
    """The features of large documents, cut at each ``"Feature"``.

    The text reader hands out records between two cuts, and a record that
    reaches over the border of two tasks is completed by the task it begins in.
    A record holds the rest of its feature and then the begin of the next,
    which the parser leaves alone.
    """
    pieces = spark.read.option("lineSep", '"Feature"').text(path)
    # what stands before the first feature opens the document
    rest = pieces.where(F.col("value").rlike(r"^\s*[,}]"))
    whole = F.concat(F.lit('{"type":"Feature"'), F.col("value"))
    parsed = F.from_json(whole, T.StructType.fromDDL(_FEATURE), {"mode": "FAILFAST"})
    return rest.select(parsed.alias("f"))


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: Sequence[str],
    lines: bool = False,
    split: bool = False,
) -> DataFrame:
    """GeoJSON polygons: the named properties as text, and ``rings``.

    A FeatureCollection is one document and is read by one task per file.
    ``lines`` reads the form with one feature per line.  ``split`` cuts a large
    document between its features and reads it with several tasks; features
    must begin with their type, as writers put it, and no text but the type may
    be the one word Feature.
    """
    if lines:
        features = (
            spark.read.schema(T.StructType.fromDDL(_FEATURE))
            .json(path)
            .select(F.struct("properties", "geometry").alias("f"))
        )
    elif split:
        features = _split_features(spark, path)
    else:
        features = (
            spark.read.schema(f"features array<struct<{_FEATURE}>>")
            .option("multiLine", True)
            .json(path)
            .select(F.explode("features").alias("f"))
        )
    return features.select(
        *[F.col("f.properties")[p].alias(p) for p in properties],
        geojson_rings(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias(
            "rings"
        ),
    )

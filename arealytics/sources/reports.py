"""Use reports: tab-separated text, zipped or plain, and yearly parquet."""

from __future__ import annotations

import csv
import json
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from arealytics.session import pin
from arealytics.sources.files import filesystem, hadoop_path, matching
from arealytics.specs import REPORT_COLUMNS

RAW_COLUMNS = ["YEAR", *REPORT_COLUMNS]
_CHUNK_ROWS = 100_000

#: Words that stand for a missing value, in both readers.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_use_reports(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Plain tab-separated reports with a header line; every column is text.

    ``columns`` names all columns of the file in order.  Without it they come
    from the header line.
    """
    reader = spark.read.option("sep", "\t").option("header", True)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return _with_nulls(reader.csv(path)).withColumn("_file", file_path())


def file_path() -> Column:
    """Full path of the file a row was read from; folders of different years
    may hold files of the same name."""
    return F.input_file_name()


def _with_nulls(df: DataFrame) -> DataFrame:
    """The words for a missing value as nulls, in every column."""
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(*NULL_WORDS), F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _ArchiveReader(DataSourceReader):
    """One partition per archive; its text is inflated and parsed in chunks, so
    neither the archive nor its text is ever held whole."""

    def __init__(self, schema: T.StructType, options):
        self.names = schema.names
        self.columns = schema.names[:-2]
        self.paths = json.loads(options["paths"])
        self.rows = int(options["chunkrows"])

    def partitions(self) -> Sequence[InputPartition]:
        return [_Archive(path) for path in self.paths]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        try:
            for chunk in self._chunks(partition.path):
                yield self._batch(chunk[self.columns].assign(_file=partition.path, _error=None))
        except Exception as problem:  # recorded, see ``failures``
            row = {c: None for c in self.names}
            row |= {"_file": partition.path, "_error": repr(problem)}
            yield self._batch(pd.DataFrame([row]))

    def _chunks(self, path: str) -> Iterator[pd.DataFrame]:
        member = path.rsplit("/", 1)[-1].removesuffix(".zip") + ".txt"
        files, inside = FileSystem.from_uri(path)
        with files.open_input_file(inside) as raw, zipfile.ZipFile(raw) as archive:
            with archive.open(member) as text:
                # all columns, so that a line of the wrong length is an error
                yield from pd.read_csv(
                    text, sep="\t", dtype=str, chunksize=self.rows,
                    keep_default_na=False, na_values=list(NULL_WORDS),
                )

    def _batch(self, chunk: pd.DataFrame) -> pa.RecordBatch:
        schema = pa.schema([(n, pa.string()) for n in self.names])
        return pa.RecordBatch.from_pandas(chunk[self.names], schema, preserve_index=False)


class ArchiveSource(DataSource):
    """``spark.read.format("zipped_reports")``"""

    @classmethod
    def name(cls) -> str:
        return "zipped_reports"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ArchiveReader(schema, self.options)


def read_zipped_reports(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = RAW_COLUMNS,
    chunk_rows: int = _CHUNK_ROWS,
    names: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, failures)`` of zip archives holding one ``<name>.txt`` each.

    Every archive is a partition of its own and is read in chunks of
    ``chunk_rows``, whatever its size; ``names`` chooses some of them by file
    name.  An archive that cannot be read yields
    one failure row and none of its rows, and does not stop the others.  The
    parsed text is pinned: both results come from one reading of the archives.
    """
    schema = text_schema([*columns, "_file", "_error"])
    paths = matching(spark, f"{path.rstrip('/')}/*.zip")
    if not paths and path.endswith(".zip"):
        paths = matching(spark, path)
    if names is not None:
        paths = [p for p in paths if p.rsplit("/", 1)[-1] in set(names)]
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.drop("_error"), empty.select("_file", "_error")
    spark.dataSource.register(ArchiveSource)
    parsed = pin(
        spark.read.format("zipped_reports").schema(schema)
        .option("paths", json.dumps(paths)).option("chunkrows", chunk_rows).load()
    )
    failures = parsed.where(F.col("_error").isNotNull()).select("_file", "_error")
    # a failure in mid-file must not leave the chunks before it behind
    rows = (
        parsed.where(F.col("_error").isNull())
        .drop("_error")
        .join(failures.select("_file"), "_file", "left_anti")
    )
    return rows, failures


def read_yearly(
    spark: SparkSession, folder: str, prefix: str, columns: Sequence[str]
) -> DataFrame:
    """Union of the yearly parquet tables ``<prefix>_20*.parquet``, by name and
    cut to ``columns``.  A table ``<prefix>_full.parquet`` does not match."""
    paths = matching(spark, f"{folder}/{prefix}_20*.parquet")
    if not paths:
        raise FileNotFoundError(f"{folder}/{prefix}_20*.parquet")
    return union_years([spark.read.parquet(p) for p in paths], columns)


def union_years(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [f.select(*[F.col(f"`{c}`") for c in columns]) for f in frames]
    )


def read_ragged_years(
    spark: SparkSession, pattern: str, years: Iterable[int]
) -> DataFrame:
    """Union of comma-separated text over years whose columns differ.

    ``pattern`` is a glob with ``{year}`` in it; a folder of the same name
    inside a year's folder is taken instead where there is one, a year without
    files is skipped, a column a year lacks is null there.  Headers are read
    first; files with the same header are one scan.
    """
    by_header: dict[tuple[str, ...], dict[str, int]] = {}
    for year in years:
        for path in _files_of_year(spark, pattern.format(year=year)):
            by_header.setdefault(tuple(header(spark, path)), {})[path] = year
    if not by_header:
        raise FileNotFoundError(pattern)
    frames = []
    for columns, paths in sorted(by_header.items()):
        scan = spark.read.option("header", True).schema(text_schema(columns)).csv(list(paths))
        # as many rows as files; names in a path may be escaped, so folders count
        folders = {p.rsplit("/", 1)[0].split(":", 1)[-1]: y for p, y in paths.items()}
        known = spark.createDataFrame(
            [(_folder_key(f), y) for f, y in folders.items()], "_folder string, _year int"
        )
        folder = F.regexp_replace(F.regexp_replace(F.input_file_name(), "/[^/]*$", ""), "^[^:/]*:/*", "/")
        frames.append(scan.withColumn("_folder", folder).join(F.broadcast(known), "_folder").drop("_folder"))
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    )


def _folder_key(folder: str) -> str:
    return quote("/" + folder.lstrip("/"), safe="/=~!$&'()*+,;:@")


def _files_of_year(spark: SparkSession, pattern: str) -> list[str]:
    folder, _, name = pattern.rpartition("/")
    inner = folder.rpartition("/")[2]
    return matching(spark, f"{folder}/{inner}/{name}") or matching(spark, pattern)


def header(spark: SparkSession, path: str) -> list[str]:
    """The first line of a comma-separated file."""
    java = spark._jvm.java.io
    stream = filesystem(spark, path).open(hadoop_path(spark, path))
    reader = java.BufferedReader(java.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return next(csv.reader([line.removeprefix("\ufeff")]), [])

"""WARC archives and a globally ordered index of their captures.

Pages are written as WARC records through Spark's own writer: every record is
UTF-8 text whose closing line breaks are the writer's line separator.  Reading
goes record by record along ``Content-Length``.  The index of all captures is
an external merge: each archive gives a locally sorted run, runs meet in key
ranges, and a loser tree merges the pieces of all runs inside a range.  Ranges
end anywhere in (URL key, time, page), so one URL with very many captures is
spread over ranges too.

Defined results: a null payload counts as empty; a null URL gives no target
field and sorts first under an empty key; a null page id is kept and, where all
pages with a payload lack one, the record is a response; rows with equal id and
payload share one type; an empty table gives an empty index; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arealytics.llm.common import through_arrow
from arealytics.session import pin, shared_folder

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATES = 250_000_000_000  # seconds of the archives' calendar
ROWS_PER_ARCHIVE = 4_000  # bounds what a task holds of one archive
ROWS_PER_RANGE = 200_000
INDEX = (
    "url_key string, captured string, page_id long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, archive string, "
    "offset long"
)
_ORDER = ("url_key", "captured", "page_id")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1; five hex digits make four letters."""
    digits = F.sha1(data)
    letters = []
    for part in range(8):
        number = F.conv(F.substring(digits, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substr(F.lit(_ALPHABET), place, F.lit(1)))
    return F.concat(*letters)


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Add payload_digest, payload_bytes, record_type and refers_to to rows
    (page_id, url, payload).  Only digests are grouped; the page keeps its
    payload and meets its result by its own id and digest."""
    judged = pages.withColumns(
        {
            "payload_digest": base32_sha1(F.col("payload")),
            "payload_bytes": F.octet_length("payload").cast("long"),
        }
    )
    slim = judged.where(F.col("payload_bytes") >= min_bytes).select(
        "page_id", "payload_digest"
    )
    firsts = slim.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("times")
    )
    # only captures that repeat an earlier one: copies, not the whole table
    repeats = (
        slim.distinct()
        .join(firsts.where("times > 1"), "payload_digest")
        .where("page_id <> first_id OR page_id IS NULL AND first_id IS NOT NULL")
        .select(
            F.col("page_id").alias("repeat_id"),
            F.col("payload_digest").alias("repeat_digest"),
            F.col("first_id").alias("refers_to"),
        )
    )
    same = (F.col("payload_digest") == F.col("repeat_digest")) & F.col(
        "page_id"
    ).eqNullSafe(F.col("repeat_id"))
    return (
        judged.join(repeats, same, "left")
        .drop("repeat_id", "repeat_digest")
        .withColumn(
            "record_type",
            F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
        )
    )


def record(epoch: str) -> Column:
    """One WARC record as text, up to the last line break, which the writer
    adds.  Revisits carry headers only."""
    id_text = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    end = F.lit("\r\n")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes"), F.lit("\r\n\r\n"),
        F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""),
    )
    # dates have four-digit years, so very large ids begin anew
    since = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(DATES))
    seconds = F.unix_timestamp(F.lit(epoch)) + since
    address = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, end), F.lit(""))

    revisit = F.when(F.col("record_type") == "revisit", F.lit(
        "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), id_text, F.lit(">"))),
        field("WARC-Date", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        field("WARC-Target-URI", address),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Profile", revisit),
        field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(http), F.lit("\r\n\r\n"), http, end,
    )


def write_archives(
    pages: DataFrame, folder: str, *, min_bytes: int = 0, epoch: str = "2020-01-01 00:00:00"
) -> None:
    """Write rows (page_id, url, payload) as gzip-compressed WARC files."""
    (
        with_types(pages, min_bytes)
        .select(record(epoch).alias("value"))
        .write.option("lineSep", "\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_ARCHIVE)
        .text(folder)
    )


def inflated(archive: bytes) -> bytes:
    """All gzip members of an archive, one after the other."""
    parts = []
    while archive:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(archive) + member.flush())
        if not member.eof:
            raise ValueError("the last gzip member is cut off")
        archive = member.unused_data
    return b"".join(parts)


def records(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the plain archive, fields, block) of every record."""
    plain = inflated(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while at < len(plain):
        head_end = plain.index(b"\r\n\r\n", at)
        head = plain[at:head_end].decode("utf-8").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in head[1:])
        start = head_end + 4
        stop = start + int(fields["Content-Length"])
        yield at, fields, plain[start:stop]
        at = stop + 4


def url_key(url: str | None) -> str:
    """Sorting key of a URL: host names from the top down, then the rest."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1]
    found = re.match(r"([^/?#]*)(.*)", rest, re.S)
    host = found[1].lower().removeprefix("www.").split(".")
    return ",".join(reversed(host)) + ")" + (found[2] or "/")


def _page(field: str | None) -> int | None:
    number = (field or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One index row per record; the payload's size and digest are computed
    from the block where there is one."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        for batch in arriving:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [
                    _entry(path.rpartition("/")[2], *found)
                    for found in records(content.as_buffer().to_pybytes())
                ]
                yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    # an archive is bounded by write_archives, so its bytes may be one value
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return through_arrow(files, batches, INDEX)


def _entry(archive: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    if kind == "response":
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"damaged payload in {archive} at byte {offset}")
    else:
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return (
        url_key(fields.get("WARC-Target-URI")),
        fields["WARC-Date"],
        _page(fields["WARC-Record-ID"]),
        size,
        digest,
        kind,
        _page(fields.get("WARC-Refers-To")),
        archive,
        offset,
    )


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, so
    taking the winner and replaying its path costs log k comparisons."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs = [r for r in runs if len(r)]
        self.at = [0] * len(self.runs)
        self.losers = [-1] * max(1, len(self.runs))
        self.winner = self._build(1) if self.runs else -1

    def _build(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self._before(b, a):
            a, b = b, a
        self.losers[node] = b
        return a

    def _before(self, a: int, b: int) -> bool:
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return done_b and not done_a
        return self.runs[a][self.at[a]] < self.runs[b][self.at[b]]

    def __iter__(self) -> Iterator:
        left = sum(map(len, self.runs))
        while left:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            left -= 1
            node = (run + len(self.runs)) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_index(runs: DataFrame) -> DataFrame:
    """Globally ordered captures from locally sorted runs (rows as INDEX).

    A key range holds pieces of many runs.  A task cuts what arrives wherever
    the order falls, which finds those pieces however they were dealt, and
    merges them; ranges are sized so that one fits a task.
    """
    names = [f.split()[0] for f in INDEX.split(", ")]
    ranges = max(1, -(-runs.count() // ROWS_PER_RANGE))
    width = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartitionByRange(max(ranges, width), *_ORDER, "archive", "offset")

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pieces: list[list[tuple]] = []
        before = None
        for batch in arriving:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                # null ids before others, as the ranges have them
                key = (row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8])
                if before is None or key < before:
                    pieces.append([])
                pieces[-1].append((key, row))
                before = key
        chunk: list[tuple] = []
        for _, row in LoserTree(pieces):
            chunk.append(row)
            if len(chunk) == 10_000:
                yield dict(zip(names, map(list, zip(*chunk))))
                chunk = []
        if chunk:
            yield dict(zip(names, map(list, zip(*chunk))))

    return through_arrow(dealt.select(*names), batches, INDEX)


def capture_histories(
    pages: DataFrame,
    *,
    min_bytes: int = 0,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write the pages as archives, read them back and merge their index."""
    spark = pages.sparkSession
    rows = pages.select(
        pages[id_column].cast("long").alias("page_id"),
        pages[url_column].cast("string").alias("url"),
        F.coalesce(pages[payload_column].cast("string"), F.lit("")).alias("payload"),
    )
    target = folder or f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
    write_archives(rows, target, min_bytes=min_bytes)
    runs = pin(read_index(spark, target).sortWithinPartitions(*_ORDER, "archive", "offset"))
    return merge_index(runs)


WARC_SQL = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload,
    sha1(coalesce(html, '')) AS digest
  FROM pages
), spelled AS (
  SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(digest, (i // 4 * 5 + 1)::INT, 5))::BIGINT
          >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY digest) AS first_id
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM spelled
"""

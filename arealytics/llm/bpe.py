"""Byte-level BPE by prefix dynamic programming.

Every byte prefix of a piece has one valid last token: the token with which the
merge order would end the encoding of that prefix.  The encoder stores it for
each prefix, so a piece can be extended without touching what is stored, and an
edit only recomputes from the edit on.  A token may follow another exactly when
no merge across their border would have come first; that is decided by undoing
the two tokens' own merges, the later one first.

Defined results: a null text counts as empty; an empty text has no ids; rows
are judged one by one, so repeated rows give repeated results; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Mapping
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from arealytics.llm.common import through_arrow

_MEMO = 200_000  # entries of each memo; they only save time


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class PrefixEncoder:
    """Encoder and decoder of single pieces for one vocabulary."""

    def __init__(self, ranks: Mapping[bytes, int]):
        self.ids = dict(ranks)
        self.vocabulary = {i: t for t, i in self.ids.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.whole: dict[bytes, int] = {}  # tokens that merging never yields
        self._fits: dict[int, bool] = {}
        for token, rank in sorted(self.ids.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            parts = self._merge(token)
            if len(parts) == 2:
                self.left[rank], self.right[rank] = parts
                self.merged[tuple(parts)] = rank
            else:
                self.whole[token] = rank
        self.automaton = ahocorasick.Automaton()  # all tokens ending at a place
        for token, rank in self.ids.items():
            if token not in self.whole:
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()

    def _merge(self, token: bytes) -> list[int]:
        """The parts of ``token`` just before its own last merge."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.ids.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def fits(self, before: int, after: int) -> bool:
        """Whether the two tokens stay apart when they meet."""
        key = (before << 20) | after
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= _MEMO:
                self._fits.clear()
            known = self._fits[key] = self._apart(before, after)
        return known

    def _apart(self, before: int, after: int) -> bool:
        bound = 1 << 60
        while True:
            if self.merged.get((before, after), bound) < bound:
                return False
            if before > after:
                bound = before
                inner = self.right.get(before)
                if inner is None:
                    return True
                before = inner
            else:
                bound = after + 1
                inner = self.left.get(after)
                if inner is None:
                    return True
                after = inner

    def prefixes(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of every prefix; ``known`` holds those of the first
        prefixes and stays as it is."""
        last = list(known or ())
        known_fit, fits, found = self._fits.get, self.fits, len(last)
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            if end < found:
                continue
            if end > found:
                break
            if size <= end:
                before = last[end - size]
                fit = known_fit((before << 20) | token)
                if fit is None:
                    fit = fits(before, token)
                if not fit:
                    continue
            last.append(token)
            found += 1
        if found < len(piece):
            raise ValueError("the vocabulary lacks a byte of the text")
        return last

    def path(self, last: list[int]) -> list[int]:
        """The encoding that the stored last tokens describe."""
        found, end = [], len(last)
        while end:
            token = last[end - 1]
            found.append(token)
            end -= len(self.vocabulary[token])
        return found[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ids.get(piece)
        return [whole] if whole is not None else self.path(self.prefixes(piece))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


class TextEncoder:
    """Whole texts: pieces of a pattern, each encoded alone."""

    def __init__(self, encoder: PrefixEncoder, pattern: str):
        self.encoder = encoder
        self.pattern = regex.compile(pattern)
        self._memo: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Encodings of several texts; their new pieces are sorted first, so
        that a piece takes over the last tokens of the prefix it shares with
        the one before."""
        cut = [self.pattern.findall(text) for text in texts]
        memo = self._memo
        fresh = set().union(*cut).difference(memo)
        if len(memo) + len(fresh) > _MEMO:
            # what this call uses stays, the rest gives way
            used = set().union(*cut)
            memo = self._memo = {p: memo[p] for p in used if p in memo}
        memo.update(self._encode_pieces(fresh))
        found = []
        for pieces in cut:
            ids: list[int] = []
            for piece in map(memo.__getitem__, pieces):
                ids += piece
            found.append(ids)
        return found

    def _encode_pieces(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        encoder, found = self.encoder, {}
        before, last = b"", []
        for raw, piece in sorted((p.encode("utf-8", "replace"), p) for p in pieces):
            whole = encoder.ids.get(raw)
            if whole is not None:
                found[piece] = (whole,)
                continue
            shared = 0
            for a, b in zip(before, raw):
                if a != b:
                    break
                shared += 1
            last = encoder.prefixes(raw, last[:shared])
            before = raw
            found[piece] = tuple(encoder.path(last))
        return found


class EditableText:
    """A text that keeps its pieces and each piece's last tokens, so that
    appending and editing give exactly the encoding of the new whole text while
    only the pieces near the change are looked at.

    A piece depends on the text from its start on and, at the end of a text, an
    ending that grows can change its last two pieces.
    """

    def __init__(self, texts: TextEncoder, text: str = ""):
        self.texts = texts
        self.text = ""
        self.pieces: list[str] = []
        self.last: list[list[int]] = []
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace ``text[start:end]`` by ``new``."""
        if not 0 <= start <= end <= len(self.text):
            raise ValueError("the edit lies outside the text")
        ends = np.cumsum([len(p) for p in self.pieces]).tolist()
        first = max(0, int(np.searchsorted(ends, start)) - 2)
        begin = ends[first - 1] if first else 0
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        old_starts = {
            e + shift: i + 1 for i, e in enumerate(ends) if e >= end
        }  # where an untouched rest may begin
        pieces, rest = [], len(self.pieces)
        for match in self.texts.pattern.finditer(text, begin):
            if match.start() >= start + len(new) and match.start() in old_starts:
                rest = old_starts[match.start()]
                break
            pieces.append(match.group())
        stored = dict(zip(self.pieces[first:rest], self.last[first:rest]))
        last = [self._prefixes(p, stored) for p in pieces]
        self.text = text
        self.pieces[first:rest] = pieces
        self.last[first:rest] = last

    def _prefixes(self, piece: str, stored: dict[str, list[int]]) -> list[int]:
        if piece in stored:
            return stored[piece]
        for old, last in stored.items():
            if piece.startswith(old):
                return self.texts.encoder.prefixes(piece.encode(), last)
        return self.texts.encoder.prefixes(piece.encode())

    def ids(self) -> list[int]:
        found: list[int] = []
        for piece, last in zip(self.pieces, self.last):
            whole = self.texts.encoder.whole.get(piece.encode())
            found += [whole] if whole is not None else self.texts.encoder.path(last)
        return found


@lru_cache(maxsize=2)
def _encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(read_ranks(path))


@lru_cache(maxsize=2)
def _ready(path: str, pattern: str) -> TextEncoder:
    """Kept for the life of a Python worker; the file lies on every machine."""
    return TextEncoder(_encoder(path), pattern)


def encode(
    documents: DataFrame,
    path: str,
    pattern: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text and decode it again.

    Gives the id, ``n_tokens``, digests of the ids and of the decoded bytes
    and, with ``with_ids``, the ids themselves.  No row meets another, so
    nothing is shuffled.  ``path`` names the vocabulary file on every machine.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        texts = _ready(path, pattern)
        encoder = texts.encoder
        names = {i: str(i) for i in encoder.vocabulary}
        for batch in arriving:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, digests, decoded, all_ids = [], [], [], []
                for ids in texts.encode_many([t or "" for t in part.column(1).to_pylist()]):
                    counts.append(len(ids))
                    joined = ",".join(map(names.__getitem__, ids))
                    digests.append(hashlib.sha256(joined.encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(np.array(ids, np.int32))
                yield {
                    "doc_id": part.column(0),
                    "n_tokens": counts,
                    "ids_sha256": digests,
                    "decoded_sha256": decoded,
                    "ids": all_ids,
                }

    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[text_column].cast("string").alias("text"),
    )
    return through_arrow(rows, batches, schema)


def decode(
    encoded: DataFrame, path: str, *, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """Texts of id lists; bytes that are no UTF-8 become U+FFFD, a null list
    gives a null text."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = _encoder(path)
        for batch in arriving:
            yield {
                "doc_id": batch.column(0),
                "text": [
                    None if ids is None else encoder.decode(ids).decode("utf-8", "replace")
                    for ids in batch.column(1).to_pylist()
                ],
            }

    rows = encoded.select(
        encoded[id_column].cast("long").alias("doc_id"), encoded[ids_column].alias("ids")
    )
    return through_arrow(rows, batches, "doc_id long, text string")

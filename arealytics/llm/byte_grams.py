"""Hashed byte n-grams of whole texts, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: ASCII letters stay, other ASCII becomes a space; bytes above stay.
_CLEAN = bytes(
    b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 19


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, cleaned texts) in pieces of about CHUNK_BYTES; a text is
    never cut, a long one makes a chunk of its own."""
    held: list[bytes] = []
    size = first = 0
    for row, text in enumerate(texts):
        raw = (text or "").lower().encode("utf-8", "replace").translate(_CLEAN)
        held.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield first, held
            held, size, first = [], 0, row + 1
    if held:
        yield first, held


def grams(
    texts: list[bytes], n: int, bits: int, within_words: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of every n-gram; a text has one space before and after it and
    grams of nothing but spaces are left out, as are, on request, those that
    reach from one word into another."""
    pad = n - 1  # zero bytes keep texts apart
    joined = b"".join(b" " + t + b" " + b"\0" * pad for t in texts)
    data = np.frombuffer(joined, np.uint8)
    count = len(data) - pad
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(count, np.uint64)
    letters = np.zeros(count, bool)
    inside = np.ones(count, bool)
    for i in range(n):
        byte = data[i : i + count]
        value = (value << np.uint64(8)) | byte
        letters |= byte > 32
        inside &= byte > 0
        if within_words and 0 < i < n - 1:
            inside &= byte > 32
    at = np.flatnonzero(letters & inside)
    with np.errstate(over="ignore"):
        bins = ((value[at] * _FACTOR) >> np.uint64(64 - bits)).astype(np.int64)
    ends = np.cumsum([len(t) + 2 + pad for t in texts])
    return np.searchsorted(ends, at, side="right"), bins


_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)


def whole_words(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of every word of cleaned texts: a polynomial hash of its
    bytes, taken from one running sum over all texts."""
    joined = b" ".join([b"", *texts, b""])
    data = np.frombuffer(joined, np.uint8)
    inside = data > 32
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(len(data), _STEP, np.uint64))
        back = np.multiply.accumulate(np.full(len(data), _BACK, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * powers)])
        value = (sums[ends] - sums[starts]) * back[starts]
        value = (value ^ (value >> np.uint64(29))) * _FACTOR
    stops = np.cumsum([len(t) + 1 for t in texts])
    return np.searchsorted(stops, starts, side="right"), (value >> np.uint64(64 - bits)).astype(np.int64)

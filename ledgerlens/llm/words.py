"""Vectorised word handling on Arrow text columns.

A text column arrives as one byte buffer plus offsets, so words, lines and
n-grams of a whole batch are found with a few numpy passes over the bytes
instead of a Python loop over words. Hashes are 64-bit polynomials of the
bytes, finished with a multiply-xor mix: stable between processes and
machines, and long enough that a collision within one document is not
expected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once: numpy needs some 100 bytes of scratch per
# byte, so this bounds a worker's memory (a longer single text is taken whole).
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[name] = have
    return have[:n]


def text_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, at, data = column.buffers()
    if len(column) == 0 or at is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(at, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for each chunk of a column."""
    data, offsets = text_parts(column)
    for lo, hi in row_chunks(offsets, limit):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


@dataclass
class Spans:
    """Non-overlapping byte ranges in text order, and the row each lies in."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # per row: index of its first span; one more entry at the end


def spans(inside: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of ``inside`` bytes; a run never crosses rows."""
    n, rows = len(inside), len(offsets) - 1
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Spans(none, none, none, np.zeros(rows + 1, dtype=np.int64))
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    start = np.flatnonzero(inside & (~before | border[:-1]))
    end = np.flatnonzero(inside & (~after | border[1:])) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    return Spans(start, end, row, first)


class ByteHash:
    """Hash of any byte range of a chunk, from one pass over its bytes."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * _power(_BASE, "up", n), dtype=np.uint64, out=self._sum[1:])
        self._down = _power(_BASE_INV, "down", n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        body = (self._sum[end] - self._sum[start]) * self._down[start]
        return mix(body + (end - start).astype(np.uint64) * _GRAM)


def gram_hashes(word: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of the n words from each place (the last n-1 places of
    the array, and windows across rows, are the caller's to leave out)."""
    if len(word) < n:
        return np.zeros(0, dtype=np.uint64)
    h = word[: len(word) - n + 1].copy()
    for k in range(1, n):
        h = h * _GRAM + word[k : len(word) - n + 1 + k]
    return mix(h + np.uint64(n))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur twice or more."""
    if len(keys) < 2:
        return np.zeros(len(keys), dtype=bool)
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, dtype=np.int64, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]

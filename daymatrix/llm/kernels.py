"""Array kernels shared by the text operators.

All of them work on one chunk of an Arrow string column at a time: the UTF-8
bytes of some documents, laid end to end, and the offsets between them. Words
are maximal runs of characters other than the six ASCII white-space ones
(``[^\\x20\\x09-\\x0D]+``); since those are single bytes in UTF-8, words are
found on bytes. A word, line or window of words is represented by a 64-bit
polynomial hash, evaluated for all spans of a chunk at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one kernel call works on (a longer document is a chunk
#: of its own). Bounds the size of the temporary arrays.
CHUNK_BYTES = 1 << 18

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    """The first ``n`` or more powers of the base and of its inverse; the
    longest tables asked for so far are kept."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n + n // 4, base, U64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS


class SpanHash:
    """Hashes of many spans ``values[start:end]`` from one cumulative sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self._down = _powers(n + 1)
        self._sum = np.zeros(n + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[:n], out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sum[end] - self._sum[start]) * self._down[start]
        return mix(raw + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of consecutive rows that
    hold about ``limit`` bytes together."""
    data, off = utf8(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a chunk, and the index of each
    row's first word (one more entry than rows)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:n]
    end[:-1] &= ~solid[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)


def windows(word_hash: np.ndarray, first: np.ndarray, k: int, whole_if_shorter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word windows of each row: ``(hash, start word, index
    of each row's first window)``. With ``whole_if_shorter`` a row of 1 to
    k - 1 words has its whole word sequence as its only window."""
    counts = np.diff(first)
    per_row = np.maximum(counts - k + 1, 0)
    if whole_if_shorter:
        per_row = np.where((counts > 0) & (counts < k), 1, per_row)
    at = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(counts)), per_row)
    start = np.arange(at[-1]) - at[:-1][row] + first[:-1][row]
    end = np.minimum(start + k, first[1:][row])
    return SpanHash(word_hash)(start, end), start, at


def per_row_sum(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]

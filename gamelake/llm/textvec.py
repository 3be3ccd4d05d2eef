"""Words, hashes and shingles of Arrow string columns as numpy arrays.

The work runs inside Spark tasks, over slices of about ``SLICE_BYTES`` of text, so a
task's memory follows its longest text and not its batch. A word is a run of bytes other
than space and U+0009..U+000D, which in UTF-8 is the same as a run of characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Words(NamedTuple):
    """Words of ``n`` texts in order: text number, byte range in ``data``, hash."""

    n: int
    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def bounds(self) -> np.ndarray:
        """n + 1 positions: where each text's words begin."""
        return np.searchsorted(self.doc, np.arange(self.n + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of slices of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], wide)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every range, from one running sum over all bytes."""
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of the texts that lie one after the other in ``data``."""
    n = len(offsets) - 1
    if lower:
        data = _LOWER[data]
    none = np.zeros(0, np.int64)
    if not len(data):
        return Words(n, data, offsets, none, none, none, none.astype(np.uint64))
    space = _SPACE[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    h = range_hash(data, start, end)
    return Words(n, data, offsets, np.searchsorted(offsets, start, "right") - 1, start, end, h)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``k`` words inside one text."""
    if len(w.doc) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(w.doc) - k + 1
    h = w.hash[:m]
    for j in range(1, k):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w.hash[j:j + m])
    at = np.flatnonzero(w.doc[:m] == w.doc[k - 1:])
    return at, h[at]


def sequence_hash(h: np.ndarray) -> np.uint64:
    """One hash of a short sequence of word hashes."""
    out = np.uint64(len(h))
    with np.errstate(over="ignore"):
        for x in h:
            out = mix(np.array([out * np.uint64(0xD6E8FEB86659FD93) + x]))[0]
    return out


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct k-word shingles; with fewer words, the whole as one."""
    at, h = shingles(w, k)
    cut = np.searchsorted(w.doc[at], np.arange(w.n + 1)) if len(at) else np.zeros(w.n + 1, np.int64)
    first = w.bounds()
    out = []
    for i in range(w.n):
        if cut[i + 1] > cut[i]:
            out.append(np.unique(h[cut[i]:cut[i + 1]]))
        elif first[i + 1] > first[i]:
            out.append(np.array([sequence_hash(w.hash[first[i]:first[i + 1]])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def long_lists(parts: list[np.ndarray]) -> pa.Array:
    """A list<int64> column from arrays of 64-bit values."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

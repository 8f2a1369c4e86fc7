"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` in the UTF-8 text
after A-Z were lower-cased: ASCII letters and digits and everything beyond ASCII.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# a..z, 0..9 and bytes from 0x80 on stand for themselves, A..Z for a..z, 0 ends a word
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD_BYTES = bytes(int(b) or 32 for b in _FOLD)

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 16


def trimmed(run):
    """``run`` for mapInArrow, after the worker gave back what earlier tasks have freed.

    Workers live on between tasks, and their allocators keep freed memory for themselves.
    """

    def begin(batches):
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
        if trim:
            trim(0)
        return run(batches)

    return begin


def words_of(text: bytes) -> list[bytes]:
    """The words of one text."""
    return text.translate(_FOLD_BYTES).split()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalising step of SplitMix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


@dataclass
class Slice:
    """Some rows of a batch: their bytes, and where each row begins."""

    rows: range
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into runs of rows of about ``size`` bytes; one row is never cut.

    Null counts as empty.
    """
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    n = len(column)
    if not n:
        return
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(buffers[1], kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1), lo + SLICE_ROWS)
        yield Slice(range(lo, hi), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice: their place, length and 64-bit hash, and where each row's words begin."""

    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words(part: Slice, lengths: tuple[int, ...] = ()) -> Words | tuple[Words, list[np.ndarray]]:
    """Split a slice into words; with ``lengths``, also hash that many leading bytes of each."""
    folded = _FOLD[part.data]
    inside = folded != 0
    n = len(folded)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = part.offsets[:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = part.offsets[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(folded * up[:n], out=sums[1:])
    sizes = stops - starts

    def hashed(size):
        return mix((sums[starts + size] - sums[starts]) * down[starts] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    found = Words(starts, sizes, hashed(sizes), np.searchsorted(starts, part.offsets))
    return (found, [hashed(np.minimum(sizes, k)) for k in lengths]) if lengths else found


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` successive words, and where each row's begin.

    A row of fewer words, but not none, has one shingle of all its words.
    """
    counts = np.diff(found.offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    factors = _powers(size + 2)[0][1:]
    n = len(found.hashes)
    sliding = np.zeros(n, np.uint64)
    for k in range(size):
        sliding[:max(n - k, 0)] += found.hashes[k:] * factors[k]
    first = np.repeat(found.offsets[:-1] - offsets[:-1], made) + np.arange(offsets[-1])
    result = sliding[first]
    short = np.flatnonzero((counts > 0) & (counts < size))
    total = np.zeros(len(short), np.uint64)
    for k in range(size):
        has = counts[short] > k
        total[has] += found.hashes[found.offsets[short[has]] + k] * factors[k]
    result[offsets[short]] = total + counts[short].astype(np.uint64)
    return mix(result), offsets

"""Numpy helpers over Arrow text columns, used inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer single text is its own chunk.
CHUNK_BYTES = 1 << 20
# Bytes that words are hashed of at once; hashing takes some forty bytes a byte.
BLOCK_BYTES = 1 << 17

_U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = next((s for s in (BLOCK_BYTES + 1, CHUNK_BYTES + 1) if n <= s), n)
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        if size > 1:
            have[1:] = _U(base)
            with np.errstate(over="ignore"):
                np.multiply.accumulate(have, out=have)
        # A longer text's table is not kept: workers live on.
        _powers[base] = have[: CHUNK_BYTES + 1].copy() if size > CHUNK_BYTES + 1 else have
    return have[:n]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system.

    Workers live on after a task; what Arrow and the C library keep for reuse would count against the executor.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def text_column(column: pa.Array) -> pa.Array:
    """The column as large strings without nulls (null counts as empty)."""
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def text_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows with about ``limit`` bytes."""
    # Read in place: a batch may hold tens of MB.
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if n == 0:
        return
    _, raw, data = column.buffers()
    kind = np.int32 if pa.types.is_string(column.type) else np.int64
    offsets = np.frombuffer(raw, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    give_back()


def words_of(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not gaps; runs never cross rows."""
    filled = ~gaps[data]
    if not len(filled):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = filled.copy()
    starts[1:] &= ~filled[:-1] | edge[1:-1]
    ends = filled.copy()
    ends[:-1] &= ~filled[1:] | edge[1:-1]
    first = np.flatnonzero(starts)
    last = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, first, side="right") - 1
    return first, last, row


class RangeHashes:
    """A 64-bit hash per byte range of ``data``, a function of its bytes alone."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_CODES[data] * _power_table(_MULTIPLIER, n + 1)[:n], out=self._sums[1:])
        self._inverse = _power_table(_INVERSE, n + 1)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self._sums[last] - self._sums[first]) * self._inverse[first]
            return mix(raw + (last - first).astype(np.uint64))


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return RangeHashes(data).of(first, last)


def hashes_in_order(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """:func:`word_hashes` of ranges that do not overlap, in their order, block by block."""
    out = np.empty(len(first), dtype=np.uint64)
    k = 0
    while k < len(first):
        # A longer range is a block of its own.
        end = max(int(np.searchsorted(last, first[k] + BLOCK_BYTES, side="right")), k + 1)
        low, high = first[k], last[end - 1]
        out[k:end] = word_hashes(data[low:high], first[k:end] - low, last[k:end] - low)
        k = end
    return out


def shingles_of(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words, lower-cased in A-Z; with repeats, in text order.

    A row with fewer words, but at least one, has its whole word sequence as one shingle.
    """
    data = LOWER[data]
    first, last, row = words_of(data, offsets)
    if not len(first):
        return row, np.zeros(0, np.uint64)
    hashes = hashes_in_order(data, first, last)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    begin = np.concatenate(([0], np.cumsum(counts)[:-1]))
    length = np.minimum(counts[row], width)
    index = np.arange(len(first))
    keep = index - begin[row] <= np.maximum(counts[row] - width, 0)
    at = index[keep]
    size = length[keep]
    out = size.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            live = k < size
            nxt = hashes[np.minimum(at + k, len(hashes) - 1)]
            out = np.where(live, mix(out * _U(0x9DDFEA08EB382D69) + nxt), out)
    return row[at], out

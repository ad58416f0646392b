"""Whole Arrow text columns as numpy bytes: words, word hashes and safe slices.

Text is handled as UTF-8 bytes. White space is 0x20 and 0x09-0x0D; a word is a run of
other bytes, so a multi-byte character never splits. Hashes are 64 bit: two different
words share one with probability 2**-64, which is treated as never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text looked at in one go. A longer text is walked in blocks of this size.
BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_KEYS = np.random.default_rng(20_240_117).integers(0, 2**64, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES) + 1
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer row forms a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto
        row = upto


def chunk_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range. Ranges are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(ends, base + BLOCK_BYTES, side="right"))
        last = max(last, first + 1)
        size = int(ends[last - 1]) - base
        powers, inverses = _power_tables(size)
        terms = _BYTE_KEYS[data[base : base + size]]
        terms *= powers[:size]
        sums = np.empty(size + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[e] - sums[s]) * inverses[s])
        first = last
    return out


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each row's words begin (n + 1 entries)."""
    space = SPACE[data]
    opens = ~space
    closes = opens.copy()
    edges = offsets[:-1][offsets[:-1] < len(data)]
    inner = space[:-1].copy()
    inner[edges[edges > 0] - 1] = True
    opens[1:] &= inner
    after = space[1:].copy()
    after[edges[edges > 0] - 1] = True
    closes[:-1] &= after
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and where each row's words begin."""
    if lower:
        data = LOWER[data]
    starts, ends, rows = word_ranges(data, offsets)
    return chunk_hashes(data, starts, ends), starts, ends, rows


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one run of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : n - width + 1 + j]
    return mix(out)

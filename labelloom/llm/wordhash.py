"""Words of Arrow text columns as 64-bit hashes, with numpy on the UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes are polynomials
over random byte values, so two of N different words collide with a chance of about N*N / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BYTES = np.random.default_rng(20_011).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
MASK = 2**64 - 1
CHUNK_BYTES = 500_000  # of texts that are taken apart at a time


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, known: list = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    while len(known[0]) < n:
        step = np.uint64(pow(_BASE, len(known[0]), 2**64))
        known[0] = np.concatenate([known[0], known[0] * step])
    return known[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and where each starts and ends; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def chunks(ends: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text has a range of its own."""
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, ends: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and length in bytes of every word; no word reaches over a text's end. ``blank``: the bytes between words."""
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans do not overlap and none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    before = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(before, lengths)  # place in the word
    values = _BYTES[data[np.repeat(starts, lengths) + at]] * _powers(int(lengths.max()))[at]
    return mix(np.add.reduceat(values, before) + lengths.astype(np.uint64))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and the number of words before each text."""
    lower = LOWER[data]
    starts, lengths = word_spans(lower, ends)
    return span_hashes(lower, starts, lengths), np.searchsorted(starts, ends)


_PLACES = np.array([pow(0xD6E8FEB86659FD93, k + 1, 2**64) for k in range(64)], np.uint64)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the number of them before each text.

    A text with fewer words has one shingle, all of them; a text without words has none.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    n = len(words)
    sums = np.zeros(n, np.uint64)
    for k in range(size):
        sums[: n - k] += words[k:] * _PLACES[k] if k < n else 0
    at = np.arange(int(out_bounds[-1])) - np.repeat(out_bounds[:-1], made) + np.repeat(bounds[:-1], made)
    sums = sums[at]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[bounds[i] : bounds[i + 1]]
        sums[out_bounds[i]] = (own * _PLACES[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(sums), out_bounds


def text_shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of a column."""
    data, ends = text_bytes(column)
    for lo, hi in chunks(ends):
        own = ends[lo : hi + 1] - ends[lo]
        hashed, bounds = shingles(*word_hashes(data[ends[lo] : ends[hi]], own), size)
        for i in range(hi - lo):
            one = np.sort(hashed[bounds[i] : bounds[i + 1]])
            if len(one) > 1:
                one = one[np.concatenate([[True], one[1:] != one[:-1]])]
            yield lo + i, one

"""Byte n-grams of whole Arrow batches: rolling windows over the bytes in numpy, distinct buckets as sorted integers.

The buckets are those of ``text.ngram_buckets``, which stays in Spark's own expressions and suits short texts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from .. import fixed_values as fv

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

CHUNK_BYTES = 1_000_000  # of texts whose n-grams are sorted at a time
LONGEST = 6  # bytes of an n-gram: its number has at most 48 bits
MARKS, MARKED = 1 << 22, 200  # most buckets that are marked in a table of flags, and buckets for each n-gram of a mean text up to which that pays


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each starts and ends; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = column.cast(pa.large_binary()).fill_null(b"")
    if not len(raw):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(raw) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _chunk(data: np.ndarray, ends: np.ndarray, sizes: list[int], buckets: int, slots: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, one text after the other, and their numbers."""
    lengths = np.diff(ends)
    if buckets * len(sizes) <= min(MARKS, MARKED * len(data) * len(sizes) // len(lengths)):
        return _marked(data, ends, sizes, buckets, slots)
    row = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(ends[1:], lengths) - np.arange(len(data))  # bytes from a place to the text's end
    width = buckets * len(sizes)
    value, keys = np.zeros(len(data), np.uint64), []
    for size in range(1, max(sizes) + 1):
        n = max(len(data) - size + 1, 0)
        value = value[:n] * np.uint64(256) + data[size - 1 :][:n]
        if size in sizes:
            inside = np.flatnonzero(left[:n] >= size)
            bucket = (value[inside] % np.uint64(buckets)).astype(np.int64) + sizes.index(size) * buckets
            keys.append(row[inside] * width + (bucket if slots is None else slots[bucket]))
    found = np.unique(np.concatenate(keys))
    return found % width, np.bincount(found // width, minlength=len(lengths))


def _marked(data: np.ndarray, ends: np.ndarray, sizes: list[int], buckets: int, slots: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``_chunk`` for long texts: each marks its buckets in a table of flags, which is read in order; nothing is sorted."""
    value, places = np.zeros(len(data), np.uint64), {}
    for size in range(1, max(sizes) + 1):
        n = max(len(data) - size + 1, 0)
        value = value[:n] * np.uint64(256) + data[size - 1 :][:n]
        if size in sizes:
            bucket = value & np.uint64(buckets - 1) if buckets & (buckets - 1) == 0 else value % np.uint64(buckets)
            bucket = bucket.astype(np.int64) + sizes.index(size) * buckets
            places[size] = bucket if slots is None else slots[bucket]
    marks, found = np.zeros(-(-buckets * len(sizes) // 8) * 8, bool), []
    words, rows = marks.view(np.uint64), marks.reshape(-1, 8)
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        for size, own in places.items():
            marks[own[lo : max(lo, hi - size + 1)]] = True
        some = np.flatnonzero(words)  # eight flags at a time
        at = np.flatnonzero(rows[some])
        found.append(some[at >> 3] * 8 + (at & 7))
        words[some] = 0
    return np.concatenate(found), np.array([len(x) for x in found])


def distinct_buckets(
    column: pa.Array, sizes: list[int], buckets: int, max_bytes: int | None = None, slots: np.ndarray | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text, buckets, numbers of buckets) of groups of texts: sorted distinct buckets of one text after the other.

    ``slots`` gives each bucket (of all sizes) another number; the distinct ones of these come instead.
    """
    if not sizes or min(sizes) < 1 or max(sizes) > LONGEST:
        raise ValueError(f"sizes: from 1 to {LONGEST}")
    data, ends = text_bytes(column)
    if max_bytes is not None:
        kept = np.minimum(np.diff(ends), max_bytes)
        at = np.repeat(ends[:-1], kept) + np.arange(int(kept.sum())) - np.repeat(np.cumsum(kept) - kept, kept)
        data, ends = data[at], np.concatenate([[0], np.cumsum(kept)])
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + chunk_bytes, "right")) - 1)
        yield lo, hi, *_chunk(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], sizes, buckets, slots)
        lo = hi


def bucket_lists(column: pa.Array, sizes: list[int], buckets: int, max_bytes: int | None = None) -> pa.Array:
    """Sorted distinct buckets of each text; null for a null text."""
    found, numbers = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for _, _, values, n in distinct_buckets(column, sizes, buckets, max_bytes):
        found.append(values)
        numbers.append(n)
    bounds = np.cumsum(np.concatenate(numbers)).astype(np.int32)
    nulls = np.append(column.is_null().to_numpy(zero_copy_only=False), False)
    values = pa.array(np.concatenate(found).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(bounds, mask=nulls) if nulls.any() else pa.array(bounds), values)


def ngram_lists(text: Column, sizes: list[int] | None = None, buckets: int = 65_536, max_bytes: int | None = None) -> Column:
    """ARRAY<INT>: sorted distinct hash buckets of the byte n-grams of the whole text (as ``text.ngram_buckets``)."""
    sizes = list(sizes or fv.NGRAM_SIZES)
    if buckets * len(sizes) > 2**31:
        raise ValueError("buckets: too many for 32 bits")

    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        return bucket_lists(column, sizes, buckets, max_bytes)

    return run(text)

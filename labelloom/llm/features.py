"""Features of texts for the classifiers: hashed words, word beginnings, and structure statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .wordhash import LOWER, chunks, mix, span_hashes, text_bytes, word_spans

#: Kinds of bytes: lower case, upper case, digit, blank, line end, punctuation, "!", "|", symbol, other.
KINDS = 10
_KIND = np.full(256, 9, np.uint8)
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[32, 9, 11, 12, 13]] = 3
_KIND[10] = 4
_KIND[[ord(c) for c in ".,;:'\"?-()"]] = 5
_KIND[ord("!")] = 6
_KIND[ord("|")] = 7
_KIND[[ord(c) for c in "*%$&#@^~<>{}[]\\/=+_`"]] = 8
STATISTICS = KINDS + 8


def statistics(data: np.ndarray, ends: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` numbers for each text; an empty text has zeros."""
    n, sizes = len(ends) - 1, np.diff(ends)
    counts = np.bincount(np.repeat(np.arange(n) * KINDS, sizes) + _KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    out = np.zeros((n, STATISTICS))
    out[:, :KINDS] = counts / np.maximum(sizes, 1)[:, None]
    amount = np.diff(bounds)
    per_word = np.maximum(amount, 1)
    same = np.zeros(len(words) + 1)
    same[2:] = np.cumsum(words[1:] == words[:-1]) if len(words) > 1 else 0
    inner = np.minimum(bounds[:-1] + 1, bounds[1:])
    extra = np.empty((n, 8))
    extra[:, 0] = np.log1p(sizes)
    extra[:, 1] = np.log1p(amount)
    extra[:, 2] = (sizes - counts[:, 3] - counts[:, 4]) / per_word / 10
    extra[:, 3] = (same[bounds[1:]] - same[inner]) / per_word
    extra[:, 4] = np.log1p(amount / (counts[:, 4] + 1))
    for i in range(n):
        own = words[bounds[i] : bounds[i + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            extra[i, 5:] = len(times) / len(own), times.max() / len(own), (times == 1).sum() / len(own)
        else:
            extra[i, 5:] = 0
    out[:, KINDS:] = extra
    return out


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, ends, word starts, word lengths, word bounds) of groups of texts."""
    data, ends = text_bytes(column)
    for lo, hi in chunks(ends):
        own, at = data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        starts, lengths = word_spans(own, at)
        yield lo, hi, own, at, starts, lengths, np.searchsorted(starts, at)


def hashed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return span_hashes(LOWER[data], starts, lengths)


def beginnings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the words that are longer, and which words those are."""
    which = np.flatnonzero(lengths > size)
    return mix(hashed(data, starts[which], np.full(len(which), size)) + np.uint64(size)), which

"""Bitmaps of fixed size that tell executors which keys may matter.

A set bit may belong to another key: a bitmap saves work and never decides. More bits save more work, so their number follows the
keys' up to ``MOST``: the share of wrong bits, and with it the work, is the same for a small and a large table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
MOST = 1 << 27  # 16 MB
BITS_A_KEY = 256


def bits_for(keys: int) -> int:
    """A power of two: ``BITS_A_KEY`` bits for each key, ``BITS`` at least and ``MOST`` at most."""
    return min(MOST, max(BITS, 1 << (BITS_A_KEY * max(keys, 1) - 1).bit_length()))


def bitmap(keys: DataFrame, key: Column, bits: int = BITS) -> np.ndarray:
    """``bits`` (a power of two) in bytes; bit ``key mod bits`` is set for every 64-bit ``key``.

    The driver gets bits / 32768 rows of 4 KB at most.
    """
    place = F.pmod(key, F.lit(bits)) + 1  # Spark counts from 1
    rows = keys.filter(key.isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    table = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in rows.collect():
        table[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.bits, np.uint8)
    return table


def holds(table: np.ndarray, keys: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Whether the bits of the keys are set; ``bits``: as given to ``bitmap``, all of the table where it is None."""
    bits = len(table) * 8 if bits is None else bits
    place = keys.view(np.uint64) & np.uint64(bits - 1)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

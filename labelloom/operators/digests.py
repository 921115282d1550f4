"""Sets of texts as 128-bit digests, with a Bloom filter of bounded size that tells in place what is surely not in a set."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import checked_broadcast

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

FEWEST_BITS, MOST_BITS = 1 << 20, 1 << 28  # the filter has 32 MB at most
BITS_EACH = 16
PROBES = 4  # bits of a member


def digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _probes(text: Column, bits: int) -> list[Column]:
    """Bits of a text, from 0, by two hashes."""
    one, two = F.xxhash64(text), F.xxhash64(F.lit(1), text).bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftright(one, 1) + F.lit(k) * F.shiftright(two, 4), F.lit(bits)) for k in range(PROBES)]


def bloom_filter(texts: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """Bits set by the texts, and their number (a power of two that follows the number of texts up to ``MOST_BITS``)."""
    bits, number = FEWEST_BITS, texts.count()
    while bits < MOST_BITS and bits < number * BITS_EACH:
        bits *= 2
    place = F.explode(F.array(*[p + 1 for p in _probes(F.col(column), bits)]))  # Spark counts from 1
    rows = texts.filter(F.col(column).isNotNull()).select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    table = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():  # bits / 32768 rows of 4 KB
        table[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.bits, np.uint8)
    return table, bits


def may_hold(table, bits: int, text: Column) -> Column:
    """False for texts that are surely not among those of the filter (a broadcast); a null text never is."""

    @F.arrow_udf("boolean")
    def held(*places: pa.Array) -> pa.Array:
        out = np.ones(len(places[0]), bool)
        for place in places:
            at = place.fill_null(0).to_numpy(zero_copy_only=False)
            out &= (table.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return pa.array(out)

    return F.coalesce(held(*_probes(text, bits)) & text.isNotNull(), F.lit(False))


def not_among(rows: DataFrame, text: str, finished: DataFrame, known: str) -> DataFrame:
    """Rows of ``rows`` whose ``text`` is not a ``known`` of ``finished`` (a null text is not).

    No text is shuffled: rows that the filter rules out stay where they are; of the others the digests are compared, and those that the filter
    holds by mistake come back by a broadcast of their digests (a join, when there are too many of them).
    """
    texts = finished.select(F.col(known).alias("__known")).filter("__known IS NOT NULL")
    table, bits = bloom_filter(texts, "__known")
    shared = rows.sparkSession.sparkContext.broadcast(table)
    marked = rows.withColumn("__maybe", may_hold(shared, bits, F.col(text)))
    done = texts.select(digest(F.col("__known")).alias("__digest")).distinct()
    maybe = marked.filter("__maybe").withColumn("__digest", digest(F.col(text)))
    mistaken = maybe.select("__digest").distinct().join(done, "__digest", "left_anti")
    back = maybe.join(checked_broadcast(mistaken), "__digest", "left_semi")
    return marked.filter(~F.col("__maybe")).select(*rows.columns).unionByName(back.select(*rows.columns))

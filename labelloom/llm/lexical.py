"""Ranked lexical search with hashed max-sketches.

A document is a bag of terms, maximal runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z as a-z.
A term's impact in a document grows with its number there (tf) and falls with the document's length; an item's score of a document sums
weight times impact over the item's terms, repeats included. All of it is in whole numbers:
``impact = 1000000000 tf div (1000 tf + 8 m)``, ``m = 25 + 75 n N div L`` and ``weight = floor(1000 ln((2 N + 2) / (2 df + 1)))``, with N documents
that have terms, L terms in all, n terms in the document and df documents with the term.

Method: the index has for every document its terms (64-bit hashes) with their numbers, and a sketch: hash buckets, ``SPREAD`` times as many as
distinct terms or more, that keep the largest number of their terms. As the impact grows with the number, that is the coordinatewise maximum of the impacts.
Items are looked up in blocks of bounded size: their weights, folded to the buckets of each sketch width, times the sketches
bound all scores of a block from above. The documents with the highest bounds are rescored first and give each item a score that its last hit
must reach. Then every task goes down its bounds, rescoring exactly on the terms, until they fall below that score or the task's own k-th.
No row is left out but by its bound, so results are exact (64-bit hashes of different terms aside).

Nulls and odd rows: null texts and texts without terms count for nothing and are never found; items without terms find nothing. Rows with equal
or null doc_id are documents of their own (null ids come last among equal scores), and items with equal or null item_id are items of their own. Other columns
are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .wordhash import LOWER, chunks, span_hashes, text_bytes, word_spans
from .workers import task

BLANK = np.ones(256, bool)  # bytes between terms
BLANK[48:58] = BLANK[65:91] = BLANK[97:123] = BLANK[128:] = False
SPREAD = 4
LEAST_WIDTH = 64
FULL = 255  # a sketch entry that says "so many or more"
TOP_IMPACT = 1_000_000  # above every impact
BLOCK_ITEMS, BLOCK_BYTES = 256, 262_144  # of the items that are looked up together
CELLS = 1 << 20  # of sketches that are multiplied at a time
STEP = 16  # documents that are rescored before the bounds are looked at again
SLACK = 1 + 1e-9  # products are summed in floating point
INDEX = "doc_id long, n long, sketch binary, terms binary, tfs binary"


# --- index -------------------------------------------------------------------------------------


def text_terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, text, hash and number of every distinct term, terms of each text with repeats) of groups of texts."""
    data, ends = text_bytes(column)
    for lo, hi in chunks(ends):
        part, own = LOWER[data[ends[lo] : ends[hi]]], ends[lo : hi + 1] - ends[lo]
        starts, lengths = word_spans(part, own, BLANK)
        hashed = span_hashes(part, starts, lengths)
        text = np.searchsorted(own, starts, "right") - 1
        order = np.lexsort((hashed, text))
        hashed, text = hashed[order], text[order]
        new = np.ones(len(text), bool)
        new[1:] = (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        yield lo, hi - lo, text[first], hashed[first], np.diff(np.append(first, len(text))), np.bincount(text, minlength=hi - lo)


def _widths(distinct: np.ndarray) -> np.ndarray:
    """Buckets of the sketches of documents with so many distinct terms: powers of two."""
    wanted = np.maximum(distinct * SPREAD, LEAST_WIDTH)
    return np.left_shift(1, np.ceil(np.log2(wanted)).astype(np.int64))


def _slices(flat: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> pa.Array:
    raw, size = flat.tobytes(), flat.itemsize
    return pa.array([raw[bounds[i] * size : bounds[i + 1] * size] for i in chosen], pa.binary())


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n", "sketch", "terms", "tfs"]
    for batch in batches:
        for lo, size, text, hashed, tf, n in text_terms(batch.column(1)):
            distinct = np.bincount(text, minlength=size)
            bounds = np.concatenate([[0], np.cumsum(distinct)])
            width = np.where(distinct > 0, _widths(distinct), 0)
            at = np.concatenate([[0], np.cumsum(width)])
            sketch = np.zeros(at[-1], np.uint8)
            place = at[text] + (hashed & (width[text] - 1).astype(np.uint64)).astype(np.int64)
            np.maximum.at(sketch, place, np.minimum(tf, FULL).astype(np.uint8))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(lo + some)), pa.array(n[some]), _slices(sketch, at, some),
                 _slices(hashed, bounds, some), _slices(tf.astype(np.uint32), bounds, some)], names)


def build_index(docs: DataFrame) -> DataFrame:
    """Written (row, doc_id, n, sketch, terms, tfs) of the documents of ``docs`` (doc_id, text) that have terms."""
    indexed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task(_indexed), INDEX)
    return materialize(indexed.withColumn("row", F.monotonically_increasing_id()), "index")


# --- items of a block ----------------------------------------------------------------------------


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def long_lengths(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms."""
    if int(n.max(initial=0)) * 75 * documents < 2**62:
        return 25 + n * (75 * documents) // terms
    return np.array([25 + 75 * int(x) * documents // terms for x in n], np.int64)


def term_weight(df: int, documents: int) -> int:
    """Weight of a term that ``df`` of ``documents`` have; 0 where none has it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) if df else 0


class Items:
    """A block of items: sorted terms and weights (times repeats) of each, and the weights folded to sketch widths."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray], documents: int, total: int):
        self.terms, self.weights, self.documents, self.total = terms, weights, documents, total
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at_width(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets that the items use and the sums of weights there, a column for each item."""
        if width not in self.folded:
            places = [(t & np.uint64(width - 1)).astype(np.int64) for t in self.terms]
            buckets = np.unique(np.concatenate([*places, np.zeros(0, np.int64)]))
            sums = np.zeros((len(buckets), len(places)))
            for i, (place, weight) in enumerate(zip(places, self.weights, strict=True)):
                np.add.at(sums[:, i], np.searchsorted(buckets, place), weight)
            self.folded[width] = buckets, sums
        return self.folded[width]

    def bounds(self, sketches: list[bytes], m: np.ndarray) -> np.ndarray:
        """Upper bounds of all scores: a row for each document, a column for each item."""
        out = np.zeros((len(sketches), len(self.terms)))
        sizes = np.array([len(s) for s in sketches])
        for width in np.unique(sizes):
            buckets, sums = self.at_width(int(width))
            rows = np.flatnonzero(sizes == width)
            step = max(1, CELLS // int(width))
            for lo in range(0, len(rows), step):
                own = rows[lo : lo + step]
                most = np.frombuffer(b"".join([sketches[i] for i in own]), np.uint8).reshape(len(own), width)[:, buckets]
                tf = most.astype(np.int64)
                bound = np.where(tf == FULL, TOP_IMPACT, impacts(tf, m[own, None]))
                out[own] = bound @ sums * SLACK
        return out

    def score(self, item: int, terms: np.ndarray, tfs: np.ndarray, m: int) -> int:
        """The exact score of a document, given its sorted terms."""
        wanted = self.terms[item]
        at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
        hit = terms[at] == wanted
        tf = tfs[at[hit]].astype(np.int64)
        return int((self.weights[item][hit] * impacts(tf, m)).sum())


# --- tasks -----------------------------------------------------------------------------------------


def _frequencies(shared):
    """(term, df) of the vocabulary's terms in the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
            df += np.bincount(at[vocabulary[at] == terms], minlength=len(vocabulary))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    return run


def _highest_bounds(shared, k: int):
    """(item, row, bound) of the ``k`` highest bounds of each item in a task; reads n, row and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        best = np.zeros((k, len(items.terms)))
        rows = np.zeros(best.shape, np.int64)
        for batch in batches:
            m = long_lengths(batch.column(0).to_numpy(), items.documents, items.total)
            bounds = np.concatenate([best, items.bounds(batch.column(2).to_pylist(), m)])
            own = np.concatenate([rows, np.repeat(batch.column(1).to_numpy()[:, None], rows.shape[1], 1)])
            top = np.argpartition(-bounds, k - 1, axis=0)[:k]
            best, rows = np.take_along_axis(bounds, top, 0), np.take_along_axis(own, top, 0)
        at, item = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(rows[at, item]), pa.array(best[at, item])], ["item", "row", "bound"])

    return run


def _rescored(shared):
    """(item, score) of the given documents and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for batch in batches:
            m = long_lengths(batch.column(1).to_numpy(), items.documents, items.total)
            scores = [
                items.score(item, np.frombuffer(terms, np.uint64), np.frombuffer(tfs, np.uint32), m[i])
                for i, (item, terms, tfs) in enumerate(
                    zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                )
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.int64())], ["item", "score"])

    return run


def _descended(shared, floors: list[int], k: int):
    """(item, doc_id, score) of each item's ``k`` best documents in a task, among those whose bounds reach its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        floor = np.maximum(np.array(floors, np.float64), 1)
        best: list[list[tuple]] = [[] for _ in floors]  # (-score, no id, id), best first
        for batch in batches:
            ids, raw, counts = batch.column(0).to_pylist(), batch.column(3), batch.column(4)
            m = long_lengths(batch.column(1).to_numpy(), items.documents, items.total)
            bounds = items.bounds(batch.column(2).to_pylist(), m)
            opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for item in np.flatnonzero((bounds >= floor).any(axis=0)):
                own = bounds[:, item]
                rows = np.flatnonzero(own >= floor[item])
                rows = rows[np.argsort(-own[rows], kind="stable")]
                for lo in range(0, len(rows), STEP):
                    if own[rows[lo]] < floor[item]:
                        break
                    for i in rows[lo : lo + STEP].tolist():
                        if i not in opened:
                            opened[i] = np.frombuffer(raw[i].as_py(), np.uint64), np.frombuffer(counts[i].as_py(), np.uint32)
                        score = items.score(item, *opened[i], m[i])
                        if score >= floor[item]:
                            best[item].append((-score, ids[i] is None, ids[i] or 0))
                    best[item] = sorted(best[item])[:k]
                    if len(best[item]) == k:
                        floor[item] = max(floor[item], -best[item][-1][0])
        found = [(item, None if none else i, -score) for item, own in enumerate(best) for score, none, i in own]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return run


# --- the operator ------------------------------------------------------------------------------------


def _blocks(rows: Iterator[Row]) -> Iterator[list[Row]]:
    """Items in blocks of bounded number and size; a longer item is a block of its own."""
    held: list[Row] = []
    size = 0
    for row in rows:
        own = len((row.text or "").encode())
        if held and (len(held) == BLOCK_ITEMS or size + own > BLOCK_BYTES):
            yield held
            held, size = [], 0
        held.append(row)
        size += own
    if held:
        yield held


def _item_terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    for *_, hashed, tf, _ in text_terms(pa.array([text or ""])):
        return hashed, tf
    return np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _ranked(found: DataFrame, k: int, *order) -> DataFrame:
    best = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return found.withColumn("rank", best).filter(F.col("rank") <= k)


def search_block(index: DataFrame, block: list[Row], documents: int, total: int, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of a block, numbered from 0."""
    sc = index.sparkSession.sparkContext
    pairs = [_item_terms(row.text) for row in block]
    vocabulary = np.unique(np.concatenate([p[0] for p in pairs]))
    df = np.zeros(len(vocabulary), np.int64)
    if len(df):
        counted = index.select("terms").mapInArrow(task(_frequencies(sc.broadcast(vocabulary))), "term long, df long")
        for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # the terms of a block at most
            df[row.term] = row.df
    weights = np.array([term_weight(int(x), documents) for x in df], np.int64)
    weighed = [(terms, weights[np.searchsorted(vocabulary, terms)] * repeats) for terms, repeats in pairs]
    shared = sc.broadcast(([t[w > 0] for t, w in weighed], [w[w > 0] for _, w in weighed], documents, total))

    bounds = index.select("n", "row", "sketch").mapInArrow(task(_highest_bounds(shared, k)), "item long, row long, bound double")
    seeds = materialize(_ranked(bounds, k, F.desc("bound"), "row").select("item", "row"), "seeds")  # k for each item
    first = index.select("row", "n", "terms", "tfs").join(F.broadcast(seeds), "row").select("item", "n", "terms", "tfs")
    scores = first.mapInArrow(task(_rescored(shared)), "item long, score long").groupBy("item")
    floors = [1] * len(block)
    for row in scores.agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():  # one for each item
        if row.n == k:
            floors[row.item] = max(1, row.least)

    found = index.select("doc_id", "n", "sketch", "terms", "tfs").mapInArrow(
        task(_descended(shared, floors, k)), "item long, doc_id long, score long"
    )
    return _ranked(found, k, F.desc("score"), F.asc_nulls_last("doc_id"))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``docs`` (doc_id, text) with the highest scores above 0 for each of
    ``items`` (item_id, text), equal scores by doc_id.

    The items come to the driver a block at a time; the documents are read once, and their index three times for each block.
    """
    spark = docs.sparkSession
    index = build_index(docs)
    documents, total = index.agg(F.count("*"), F.sum("n")).first()
    kind = items.schema["item_id"].dataType.simpleString()
    out = None
    for block in _blocks(items.select("item_id", "text").toLocalIterator()) if documents else ():
        names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(block)], f"item long, item_id {kind}")
        found = materialize(search_block(index, block, documents, total, k), "found").join(F.broadcast(names), "item")
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out

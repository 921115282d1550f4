"""Phrase collocations by HAT-trie counting.

Texts (A-Z as a-z) are split at ``. , ; : ! ?`` and line ends into pieces, and those at blanks and tabs into words. Of each language
(null: ``und``), candidates are phrases of 2 to ``LONGEST`` words that occur ``least`` times or more; a phrase's score is
``floor(2000000 a / (l + r))`` with its own count a and the counts l and r of its two parts, at the cut with the lowest score (then the earliest).
Candidates that lie inside a longer one with ``share`` percent of their count or more are dropped; the best by (score, count, phrase) stay.

Method: a word's id is a 64-bit hash of it and its language. Every task counts phrases in a trie over the bytes of their word ids, most
significant first: hash containers hold the counts below a prefix, and a container with too many phrases bursts into a node with a container
for each next byte. When the trie is full, the largest subtrees at its root are spilled as sorted runs; Spark deals the runs by the prefix of
two words and merges them there. Words are counted first, then pairs of frequent words, and in a third pass the longer phrases whose
pairs are all frequent; the tasks hold bitmaps of bounded size of what is frequent (a wrong bit costs work, not results).
So every count that is needed is exact, and runs hold few rare phrases. Scores are computed in 38-digit decimals.

Nulls and odd rows: a null text is empty; rows count as often as they are given and their ids are not looked at; other columns are ignored.
A table without words gives no rows. The language ``und`` and null are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bitmap, holds
from .scratch import materialize
from .wordhash import LOWER, chunks, mix, span_hashes, text_bytes, word_spans
from .workers import task

LONGEST = 4
BREAK = np.zeros(256, bool)  # bytes between pieces
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BLANK = BREAK.copy()
BLANK[[9, 32]] = True
BURST = 4_096  # phrases of a container
HELD = 600_000  # phrases of a trie
RUN_ROWS = 20_000  # of a batch of a spilled run
FEWEST_BITS, MOST_BITS = 1 << 20, 1 << 26
BITS_EACH = 16


# --- the trie ------------------------------------------------------------------------------------


class Trie:
    """Counts of keys (equally long byte strings: word ids one after the other)."""

    def __init__(self) -> None:
        self.root: list = [None] * 256  # None, a container (dict) or a node (list) for each first byte
        self.sizes = [0] * 256  # distinct keys below each
        self.held = 0

    def add(self, keys: list[bytes], counts: list[int]) -> None:
        root = self.root
        for key, count in zip(keys, counts, strict=True):
            slots, depth = root, 0
            below = slots[key[0]]
            while type(below) is list:
                slots, depth = below, depth + 1
                below = slots[key[depth]]
            if below is None:
                below = slots[key[depth]] = {}
            known = below.get(key)
            if known is None:
                below[key] = count
                self.sizes[key[0]] += 1
                self.held += 1
                if len(below) > BURST and depth + 1 < len(key):
                    slots[key[depth]] = self._burst(below, depth + 1)
            else:
                below[key] = known + count

    @staticmethod
    def _burst(container: dict[bytes, int], depth: int) -> list:
        node: list = [None] * 256
        for key, count in container.items():
            if node[key[depth]] is None:
                node[key[depth]] = {}
            node[key[depth]][key] = count
        return node

    def _sorted(self, below) -> Iterator[tuple[bytes, int]]:
        if type(below) is dict:
            yield from sorted(below.items())
        elif below is not None:
            for child in below:
                yield from self._sorted(child)

    def spill(self, leave: int) -> Iterator[tuple[bytes, int]]:
        """Sorted runs of the largest subtrees at the root, until at most ``leave`` keys are held."""
        for first in sorted(range(256), key=lambda b: -self.sizes[b]):
            if self.held <= leave:
                break
            yield from self._sorted(self.root[first])
            self.held -= self.sizes[first]
            self.root[first], self.sizes[first] = None, 0


# --- words and phrases ---------------------------------------------------------------------------


def text_words(languages: pa.Array, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts and lengths of words, text and piece of each, word ids) of groups of texts."""
    named = {x: span_hashes(*_whole(x))[0] for x in languages.unique().to_pylist()}
    kinds = np.array([named[x] for x in languages.to_pylist()], np.uint64)
    data, ends = text_bytes(texts)
    for lo, hi in chunks(ends):
        part, own = LOWER[data[ends[lo] : ends[hi]]], ends[lo : hi + 1] - ends[lo]
        starts, lengths = word_spans(part, own, BLANK)
        text = np.searchsorted(own, starts, "right") - 1
        piece = np.cumsum(BREAK[part])[starts] if len(starts) else starts
        ids = mix(span_hashes(part, starts, lengths) + kinds[lo + text] * np.uint64(0xD1342543DE82EF95))
        yield part, starts, lengths, lo + text, piece, ids


def _whole(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\0" + text.encode(), np.uint8)
    return raw, np.zeros(1, np.int64), np.array([len(raw)])


def joined_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of the ids that stand in the same place of each column."""
    out = np.zeros(len(columns[0]), np.uint64)
    for k, ids in enumerate(columns):
        out = mix(out + ids * np.uint64(0x9E3779B97F4A7C15 + 2 * k))
    return out


def phrase_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` ids from each place on."""
    n = max(len(ids) - size + 1, 0)
    return joined_hash([ids[k : k + n] for k in range(size)])


def phrases(text: np.ndarray, piece: np.ndarray, size: int, known: np.ndarray, inner: int) -> np.ndarray:
    """Places where a phrase of ``size`` words starts whose phrases of ``inner`` words are all ``known`` (by place)."""
    n = max(len(text) - size + 1, 0)
    last = slice(size - 1, size - 1 + n)
    same = (text[:n] == text[last]) & (piece[:n] == piece[last])
    for k in range(size - inner + 1):
        same &= known[k : k + n]
    return np.flatnonzero(same)


def _names(sizes: tuple[int, ...]) -> list[str]:
    return [f"w{k}" for k in range(max(sizes))]


def _runs(found: Iterator[tuple[bytes, int]], size: int, longest: int) -> Iterator[pa.RecordBatch]:
    names = [*_names((longest,)), "f"]
    held: list[tuple[bytes, int]] = []

    def batch() -> pa.RecordBatch:
        words = np.frombuffer(b"".join([key for key, _ in held]), ">u8").reshape(-1, size).astype(np.uint64)
        columns = [pa.array(words[:, k].copy().view(np.int64)) for k in range(size)]
        columns += [pa.nulls(len(held), pa.int64())] * (longest - size)
        return pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in held], pa.int64())], names)

    for entry in found:
        held.append(entry)
        if len(held) == RUN_ROWS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _counted(sizes: tuple[int, ...], frequent, inner: int):
    """Sorted runs (w0, ..., f) of the phrases of ``sizes`` words in a task whose phrases of ``inner`` words are in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {size: Trie() for size in sizes}
        table = frequent.value
        for batch in batches:
            for *_, text, piece, ids in text_words(batch.column(0), batch.column(1)):
                known = holds(table, phrase_hashes(ids, inner), len(table) * 8)
                for size, trie in tries.items():
                    places = phrases(text, piece, size, known, inner)
                    if not len(places):
                        continue
                    _, first, counts = np.unique(phrase_hashes(ids, size)[places], return_index=True, return_counts=True)
                    raw = ids[places[first][:, None] + np.arange(size)].astype(">u8").tobytes()
                    width = 8 * size
                    trie.add([raw[i : i + width] for i in range(0, len(raw), width)], counts.tolist())
                    if trie.held > HELD // len(sizes):
                        yield from _runs(trie.spill(HELD // len(sizes) // 2), size, max(sizes))
        for size, trie in tries.items():
            yield from _runs(trie.spill(0), size, max(sizes))

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, id, f) of the words in a task, in runs."""
    known: dict[int, list] = {}

    def flushed() -> pa.RecordBatch:
        rows = sorted((lang, word, key, n) for key, (lang, word, n) in known.items())
        known.clear()
        lang, word, key, n = zip(*rows, strict=True) if rows else ((), (), (), ())
        ids = pa.array(np.array(key, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(word, pa.binary()), ids, pa.array(n, pa.int64())], ["lang", "word", "w0", "f"]
        )

    for batch in batches:
        languages = batch.column(0).to_pylist()
        for part, starts, lengths, text, _, ids in text_words(batch.column(0), batch.column(1)):
            keys, first, counts = np.unique(ids, return_index=True, return_counts=True)
            for key, at, n in zip(keys.tolist(), first.tolist(), counts.tolist(), strict=True):
                entry = known.get(key)
                if entry is None:
                    word = part[starts[at] : starts[at] + lengths[at]].tobytes()
                    known[key] = [languages[text[at]], word, n]
                else:
                    entry[2] += n
            if len(known) > HELD:
                yield flushed()
    yield flushed()


# --- the operator ----------------------------------------------------------------------------------


def _hashed(size: int):
    """The hash of the phrases in the first ``size`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(k).to_numpy().view(np.uint64) for k in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array(joined_hash(ids).view(np.int64))], ["hash"])

    return run


def _frequent_bitmap(frequent: DataFrame, size: int):
    """Broadcast bitmap of the frequent phrases of ``size`` words; its size follows their number up to ``MOST_BITS``."""
    bits = FEWEST_BITS
    number = frequent.count()
    while bits < MOST_BITS and bits < number * BITS_EACH:
        bits *= 2
    hashes = frequent.select(*_names((size,))).mapInArrow(_hashed(size), "hash long")
    return frequent.sparkSession.sparkContext.broadcast(bitmap(hashes, F.col("hash"), bits))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, w0, f) of all words of ``texts`` (lang, text)."""
    runs = texts.mapInArrow(task(_words), "lang string, word binary, w0 long, f long")
    return runs.groupBy("lang", "word", "w0").agg(F.sum("f").alias("f"))


def phrase_counts(texts: DataFrame, sizes: tuple[int, ...], frequent, inner: int, least: int) -> DataFrame:
    """(w0, ..., f) of the phrases of ``sizes`` words with ``least`` occurrences or more; the last words of shorter ones are null."""
    words = _names(sizes)
    runs = texts.mapInArrow(task(_counted(sizes, frequent, inner)), ", ".join(f"{name} long" for name in [*words, "f"]))
    merged = runs.repartition(*words[:2]).groupBy(*words).agg(F.sum("f").alias("f"))
    return merged.filter(F.col("f") >= least)


def _phrase(size: int) -> Column:
    return F.array_compact(F.array(*_names((size,)))).alias("p")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """p, a, l, r, score of each candidate at its lowest cut."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("p") - 1)))
    cuts = cuts.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("left"), F.slice("p", F.col("k") + 1, F.size("p")).alias("right"))
    cuts = cuts.join(counts.select(F.col("p").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("CAST(2000000BD * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + r) AS LONG)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("p", "a").agg(lowest).select("p", "a", "cut.l", "cut.r", "cut.score")


def _inside(candidates: DataFrame) -> DataFrame:
    """(p, longer): phrases inside longer candidates, and the largest count of those."""
    size = F.size("p")
    parts = [
        F.when((size > n) & (size >= at + n), F.slice("p", at + 1, n)) for n in range(2, LONGEST) for at in range(LONGEST - n + 1)
    ]
    longer = candidates.filter(size > 2).select(F.explode(F.array_compact(F.array(*parts))).alias("p"), "a")
    return longer.groupBy("p").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, share: int = 80, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``best`` candidates of each language of ``docs`` (lang, text)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = materialize(word_counts(texts), "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = materialize(every.filter(F.col("f") >= least), "frequent")
    pairs = materialize(phrase_counts(texts, (2,), _frequent_bitmap(words, 1), 1, least), "pairs")
    longer = phrase_counts(texts, tuple(range(3, LONGEST + 1)), _frequent_bitmap(pairs, 2), 2, least)
    longer = materialize(longer, "longer")
    phrases_ = pairs.select(_phrase(2), "f").unionByName(longer.select(_phrase(LONGEST), "f"))
    counts = words.select(_phrase(1), "f").unionByName(phrases_)
    candidates = phrases_.withColumnRenamed("f", "a")

    scored = _scored(candidates, counts).join(_inside(candidates), "p", "left")
    kept = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")
    first = words.select(F.col("w0"), "lang")
    kept = kept.withColumn("w0", F.col("p")[0]).join(first, "w0").drop("w0")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = materialize(kept.withColumn("__place", F.rank().over(order)).filter(F.col("__place") <= best).drop("__place"), "near")

    spelled = near.select("p", F.posexplode("p").alias("at", "w0")).join(words.select("w0", "word"), "w0")
    spelled = spelled.groupBy("p").agg(F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("words"))
    named = near.join(spelled, "p").withColumn("phrase", F.array_join("words.word", " ")).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

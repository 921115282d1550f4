"""Language of a text by ranked character n-gram profiles.

A profile has the ``top`` commonest n-grams of a language's texts in order (equal counts by code point). A text's score for a language adds ``top - rank``
(ranks from 0) for every profile entry that the text holds; the best score names the language, equal scores by the language's
name, and the margin over the second, as a share of the best, is the confidence. Whole texts count, in lower case.
A null or empty text, or one that holds no entry, has no language and confidence 0.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .routing import Step, classifier

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

SIZES = (1, 2, 3)
TOP = 300
HELD = 200_000  # n-grams that a task counts before it passes them on
MAX_ENTRIES = 1_000_000  # of all profiles, which every task holds


SLAB = 1 << 20  # characters that are looked at together; a longer text is a slab of its own
DENSE = 1 << 22  # entries of a table by number


def _slabs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(from, to) of texts with about ``SLAB`` characters together."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > SLAB:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if texts:
        yield lo, len(texts)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts with a mark after each, and the places of the marks."""
    marks = np.cumsum([len(t) + 1 for t in texts]) - 1
    return np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32).astype(np.int64), marks


def _gram_counts(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[str, int]]:
    """(n-gram, times) of a slab."""
    points, marks = _points(texts)
    seen = np.bincount(points)
    seen[0] -= len(marks)
    letters = np.flatnonzero(seen)
    code = np.zeros(len(seen), np.int64)
    code[letters] = np.arange(1, len(letters) + 1)
    codes, base = code[points], len(letters) + 1
    codes[marks] = 0
    for n in sizes:
        if base**n >= 2**62:  # too many for numbers
            yield from Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1)).items()
            continue
        keys = np.zeros(max(0, len(codes) - n + 1), np.int64)
        for k in range(n):
            keys = keys * base + codes[k : k + len(keys)]
        if base**n <= DENSE:
            times = np.bincount(keys)
            keys = np.flatnonzero(times)
            times = times[keys]
        else:
            keys, times = np.unique(keys, return_counts=True)
        digits = np.stack([keys // base ** (n - 1 - k) % base for k in range(n)], 1)
        whole = (digits > 0).all(1)
        grams = letters[digits[whole] - 1].astype(np.uint32).tobytes().decode("utf-32-le")
        yield from zip((grams[i : i + n] for i in range(0, len(grams), n)), times[whole].tolist(), strict=True)


class _Finder:
    """Points by language of the texts of a slab: the n-grams of the profiles as a tree that is walked from every character at once."""

    def __init__(self, entries: dict[str, list[tuple[str, int]]]):
        grams = sorted(entries)
        self.langs = sorted({lang for gram in grams for lang, _ in entries[gram]})
        letters = sorted({ord(c) for gram in grams for c in gram})
        self.letters, self.base = np.array(letters, np.int64), len(letters) + 1
        number = {chr(c): k + 1 for k, c in enumerate(letters)}
        tree: dict[int, int] = {}  # node and letter to node; 0 leads nowhere, 1 is the root
        ends, place = [], {lang: k for k, lang in enumerate(self.langs)}
        for gram in grams:
            node = 1
            for c in gram:
                node = tree.setdefault(node * self.base + number[c], len(tree) + 2)
            ends.append(node)
        self.depth = max(map(len, grams), default=0)
        self.gram = np.full(len(tree) + 2, -1, np.int64)
        self.gram[ends] = np.arange(len(grams))
        self.steps = np.array(sorted(tree), np.int64)
        self.nodes = np.array([tree[k] for k in self.steps.tolist()], np.int64)
        self.table = None
        if len(self.gram) * self.base <= DENSE:
            self.table = np.zeros(len(self.gram) * self.base, np.int64)
            self.table[self.steps] = self.nodes
        self.first = np.cumsum([0, *(len(entries[gram]) for gram in grams)])
        self.lang = np.array([place[lang] for gram in grams for lang, _ in entries[gram]], np.int64)
        self.worth = np.array([n for gram in grams for _, n in entries[gram]], np.float64)

    def _step(self, keys: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[keys]
        at = np.minimum(np.searchsorted(self.steps, keys), len(self.steps) - 1)
        return np.where(self.steps[at] == keys, self.nodes[at], 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Points, texts by languages."""
        out = np.zeros((len(texts), len(self.langs)))
        grams = len(self.first) - 1
        if not grams:
            return out
        points, marks = _points(texts)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        codes = np.where(self.letters[at] == points, at + 1, 0)
        codes[marks] = 0
        lo = 0
        rows = max(1, DENSE // grams)
        for first in range(0, len(texts), rows):
            some = marks[first : first + rows]
            part = codes[lo : some[-1] + 1]
            row = np.repeat(np.arange(len(some)), np.diff(some, prepend=lo - 1))
            held, nodes = np.zeros(len(some) * grams, bool), np.ones(len(part), np.int64)
            for k in range(self.depth):
                nodes = self._step(nodes[: len(part) - k] * self.base + part[k:])
                gram = self.gram[nodes]
                known = np.flatnonzero(gram >= 0)
                held[row[known] * grams + gram[known]] = True
            found = np.flatnonzero(held)
            gram, times = found % grams, np.diff(self.first)[found % grams]
            entry = np.repeat(self.first[gram] - np.cumsum(times) + times, times) + np.arange(times.sum())
            place = np.repeat(found // grams, times) * len(self.langs) + self.lang[entry]
            sums = np.bincount(place, self.worth[entry], len(some) * len(self.langs))
            out[first : first + len(some)] = sums.reshape(len(some), -1)
            lo = some[-1] + 1
        return out


@dataclass(frozen=True)
class Profiles:
    """``entries``: language and n-gram to rank; at most ``MAX_ENTRIES``."""

    entries: dict[str, list[tuple[str, int]]]  # n-gram: (language, points)
    sizes: tuple[int, ...]

    def scores(self, df: DataFrame) -> DataFrame:
        """Add ``lang_pred`` and ``lang_confidence``: a projection, also on streams."""
        shared = df.sparkSession.sparkContext.broadcast(self.entries)

        @F.arrow_udf("struct<lang:string,confidence:double>")
        def run(texts: pa.Array) -> pa.Array:
            found = _Finder(shared.value)
            texts = [t or "" for t in texts.to_pylist()]
            names, sure = [], []
            for lo, hi in _slabs(texts):
                for points in found.scores(texts[lo:hi]):
                    best, second = ([*np.sort(points)[::-1][:2].tolist(), 0.0, 0.0])[:2]
                    names.append(found.langs[int(points.argmax())] if best else None)  # of equal ones the first name
                    sure.append((best - second) / best if best else 0.0)
            return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["lang", "confidence"])

        found = df.withColumn("__found", run(F.lower("text")))
        return found.withColumns({"lang_pred": F.col("__found.lang"), "lang_confidence": F.col("__found.confidence")}).drop("__found")


def gram_ranks(df: DataFrame, sizes: tuple[int, ...] = SIZES, top: int = TOP) -> DataFrame:
    """(lang, rank, gram, n): the profile of every language of ``df`` (text, lang). Rows without a language are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def rows() -> pa.RecordBatch:
            found = [(lang, gram, n) for lang, counts in held.items() for gram, n in counts.items()]
            held.clear()
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "gram", "n"])

        for batch in batches:
            own: dict[str, list[str]] = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own[lang].append(text)
            for lang, texts in own.items():
                for lo, hi in _slabs(texts):
                    for gram, n in _gram_counts(texts[lo:hi], sizes):
                        held[lang][gram] += n
                    if sum(map(len, held.values())) > HELD:
                        yield rows()
        yield rows()

    known = df.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.lower("text").alias("text"))
    sums = known.mapInArrow(counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))  # Spark keeps the first rows of each task only
    return sums.withColumn("rank", order - 1).filter(F.col("rank") < top).select("lang", F.col("rank").cast("bigint").alias("rank"), "gram", "n")


def train_profiles(df: DataFrame, sizes: tuple[int, ...] = SIZES, top: int = TOP) -> Profiles:
    """Profiles of the languages of ``df`` (text, lang); more than ``MAX_ENTRIES`` entries in all are an error."""
    ensure_checkpoint_dir(df.sparkSession)
    ranks = gram_ranks(df, sizes, top).limit(MAX_ENTRIES + 1).toArrow()
    if ranks.num_rows > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} profile entries: fewer languages or a smaller top")
    entries: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for lang, rank, gram in zip(*[ranks.column(c).to_pylist() for c in ("lang", "rank", "gram")], strict=True):
        entries[gram].append((lang, top - rank))
    return Profiles(dict(entries), tuple(sizes))


def language_by_profiles(
    profiles: Profiles, non_english_label: str, english_label: str | None = None, min_confidence: float = 0.1, english: str = "en"
) -> Step:
    """Route step: texts in other languages get a label, English ones a label or fall through; texts below ``min_confidence`` fall through."""

    def score(df: DataFrame) -> DataFrame:
        known = profiles.scores(df)
        sure = F.col("lang_pred").isNotNull() & (F.col("lang_confidence") >= F.lit(float(min_confidence)))
        label = F.when(sure & (F.col("lang_pred") != english), F.lit(non_english_label)).when(sure, F.lit(english_label))
        return known.withColumns({"label": label, "confidence": F.col("lang_confidence")}).drop("lang_pred", "lang_confidence")

    return classifier(score, method="language")

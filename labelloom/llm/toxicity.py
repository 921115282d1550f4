"""Toxicity: a classifier chain over categories.

Features of a text: which words it holds, and which beginnings of 4, 5 and 6 bytes of longer words (A-Z as a-z), as 64-bit hashes.
Class counts over the sample pick the ``FEATURES`` words and beginnings that tell the classes apart best.
One linear model per category, in order: a later one also sees the probabilities of the earlier categories. In training these
are out-of-fold predictions, so that a later model learns how far they can be trusted.

Training takes a sample of at most about ``POSITIVE`` + ``NEGATIVE`` labelled rows, picked by a hash; the chain is fitted in one
task on their picked features. The model has a fixed size and is broadcast. Scoring reads whole texts and does not shuffle.

Nulls and ties: a null text is scored as an empty one, rows with null labels do not train. Repeated rows are scored each.
Without positive and negative rows all probabilities are 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import beginnings, hashed, text_chunks
from .quality import hashed_sample

FEATURES, LEAST_ROWS = 4_000, 3
POSITIVE, NEGATIVE = 6_000, 9_000
FOLDS, STEPS, RATE, RIDGE = 3, 300, 0.5, 0.3
SIZES = (4, 5, 6)
#: Categories before the last one, by seed words: a toxic text with such a word belongs to the category.
CATEGORIES = {
    "insult": ("idiot", "moron", "clown", "loser", "stupid"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "disgusting"),
}


def text_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct feature hashes) of every text."""
    for lo, hi, data, _, starts, lengths, bounds in text_chunks(column):
        parts = [(hashed(data, starts, lengths), np.arange(len(starts)))]
        parts += [beginnings(data, starts, lengths, size) for size in SIZES]
        owner = np.repeat(np.arange(hi - lo), np.diff(bounds))
        rows = np.concatenate([owner[w] for _, w in parts])
        marks = np.concatenate([h for h, _ in parts])[np.argsort(rows, kind="stable")]
        ends = np.cumsum(np.bincount(rows, minlength=hi - lo))
        for i in range(hi - lo):
            yield lo + i, np.unique(marks[ends[i - 1] if i else 0 : ends[i]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of either class that hold a feature, for the features that some positive row of the task holds."""
    for batch in batches:
        labels = batch.column(1).to_numpy()
        held: tuple[list, list] = ([], [])
        for row, marks in text_features(batch.column(0)):
            held[int(labels[row])].append(marks)
        sides = [np.unique(np.concatenate([np.zeros(0, np.uint64), *h]), return_counts=True) for h in held]
        for side, (marks, times) in enumerate(sides):
            for a in range(0, len(marks), 100_000):
                one, n = marks[a : a + 100_000].view(np.int64), times[a : a + 100_000].astype(np.int64)
                none = np.zeros(len(one), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(n if side else none), pa.array(none if side else n)], ["mark", "good", "bad"]
                )


def _picked(marks: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, marks)
    at[at == len(known)] = 0
    return at[known[at] == marks] if len(known) else np.zeros(0, np.int64)


def _rows(known, categories: dict[str, tuple[str, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        seeds = {}
        for name, words in categories.items():
            data = np.frombuffer("".join(words).encode(), np.uint8)
            sizes = np.array([len(w.encode()) for w in words])
            seeds[name] = hashed(data, np.cumsum(sizes) - sizes, sizes)
        for batch in batches:
            labels = batch.column(1).to_pylist()
            out = []
            for row, marks in text_features(batch.column(0)):
                own = [int(labels[row] and np.isin(seeds[c], marks).any()) for c in categories] + [int(labels[row])]
                out.append((own, _picked(marks, table).astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.list_(pa.int32())), pa.array([r[1] for r in out], pa.binary())],
                ["labels", "features"],
            )

    return run


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic regression on held features and on some dense columns."""

    def __init__(self, features: int, dense: int):
        self.w, self.d, self.b = np.zeros(features), np.zeros(dense), 0.0

    def scores(self, rows: np.ndarray, columns: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return _logistic(np.bincount(rows, self.w[columns], len(dense)) + dense @ self.d + self.b)

    def fit(self, rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, labels: np.ndarray) -> Linear:
        squares = [np.full_like(self.w, 1e-3), np.full_like(self.d, 1e-3), 1e-3]
        for _ in range(STEPS):
            slope = self.scores(rows, columns, dense) - labels
            w = np.bincount(columns, slope[rows], len(self.w)) + RIDGE * self.w
            d = slope @ dense + RIDGE * self.d
            b = slope.sum()
            squares = [squares[0] + w * w, squares[1] + d * d, squares[2] + b * b]
            self.w -= RATE * w / np.sqrt(squares[0])
            self.d -= RATE * d / np.sqrt(squares[1])
            self.b -= RATE * b / np.sqrt(squares[2])
        return self


class Chain:
    def __init__(self, models: list[Linear]):
        self.models = models

    def scores(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.models)))
        for k, model in enumerate(self.models):
            out[:, k] = model.scores(rows, columns, out[:, :k])
        return out

    @classmethod
    def fit(cls, held: list[np.ndarray], labels: np.ndarray, features: int) -> Chain:
        n, categories = labels.shape
        fold = np.arange(n) % FOLDS
        sizes = np.array([len(h) for h in held])
        rows, columns = np.repeat(np.arange(n), sizes), np.concatenate([np.zeros(0, np.int64), *held])
        models, earlier = [], np.zeros((n, 0))
        for k in range(categories):
            blind = np.zeros(n)  # predictions by models that have not seen the row
            for f in range(FOLDS):
                seen = fold != f
                use = seen[rows]
                place = np.cumsum(seen) - 1
                model = Linear(features, k).fit(place[rows[use]], columns[use], earlier[seen], labels[seen, k])
                blind[~seen] = model.scores(rows, columns, earlier)[~seen]
            models.append(Linear(features, k).fit(rows, columns, earlier, labels[:, k]))
            earlier = np.column_stack([earlier, blind])
        return cls(models)

    def packed(self) -> bytes:
        return np.concatenate([np.concatenate([m.w, m.d, [m.b]]) for m in self.models]).tobytes()

    @classmethod
    def opened(cls, data: bytes, features: int, categories: int) -> Chain:
        values, at, models = np.frombuffer(data), 0, []
        for k in range(categories):
            model = Linear(features, k)
            model.w, model.d = values[at : at + features], values[at + features : at + features + k]
            model.b = float(values[at + features + k])
            at += features + k + 1
            models.append(model)
        return cls(models)


def _train(features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            ((b, a) for x in batches for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)),
            key=lambda r: (r[0], r[1]),
        )
        order = np.random.default_rng(3).permutation(len(rows))  # folds that do not follow the content
        held = [np.frombuffer(rows[i][0], np.int32).astype(np.int64) for i in order]
        chain = Chain.fit(held, np.array([rows[i][1] for i in order], float), features)
        yield pa.RecordBatch.from_arrays([pa.array([chain.packed()], pa.binary())], ["model"])

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", categories: dict[str, tuple[str, ...]] = CATEGORIES):
    """(feature hashes, model bytes), both of bounded size; None without positive or negative rows."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", (F.col(label) > 0).cast("long").alias("__label"))
    key = F.col("doc_id")
    picked = hashed_sample(known.filter("__label = 1"), key, POSITIVE).unionAll(
        hashed_sample(known.filter("__label = 0"), key, NEGATIVE)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "__label")  # bounded sample
    total = {r["__label"]: r.n for r in rows.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return None
    pos, neg = F.lit(float(total[1])), F.lit(float(total[0]))
    counts = rows.mapInArrow(_counts, "mark long, good long, bad long").groupBy("mark").agg(
        F.sum("good").alias("a"), F.sum("bad").alias("b")
    )
    lift = F.log((F.col("a") + 0.5) / (pos + 1)) - F.log((F.col("b") + 0.5) / (neg + 1))
    told = counts.filter(F.col("a") >= LEAST_ROWS).withColumn("told", lift * (F.col("a") - F.col("b") * pos / neg))
    best = told.filter(lift > 1).orderBy(F.desc("told"), "mark").limit(FEATURES).select("mark").collect()
    marks = np.unique(np.array([r.mark for r in best], np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    made = rows.mapInArrow(_rows(shared, categories), "labels array<int>, features binary")
    model = made.repartition(1).mapInArrow(_train(len(marks)), "model binary").first()
    return marks, bytes(model.model)


def _score(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, data = model.value
        chain = Chain.opened(data, len(marks), len(names))
        for batch in batches:
            held = [_picked(m, marks) for _, m in text_features(batch.column(1))]
            sizes = np.array([len(h) for h in held], np.int64)
            scores = chain.scores(
                np.repeat(np.arange(len(held)), sizes), np.concatenate([np.zeros(0, np.int64), *held]), len(held)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c.copy()) for c in scores.T]], ["doc_id", *names])

    return run


def score(docs: DataFrame, model, categories: dict[str, tuple[str, ...]] = CATEGORIES, last: str = "toxic") -> DataFrame:
    """doc_id and a probability ``p_<category>`` for every category in the chain's order."""
    names = [f"p_{c}" for c in [*categories, last]]
    if model is None:
        return docs.select("doc_id", *[F.lit(0.0).alias(n) for n in names])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names)
    return docs.select("doc_id", "text").mapInArrow(_score(shared, names), schema)

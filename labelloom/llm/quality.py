"""Quality classifier: a factorisation machine.

Features of a text: words hashed to ``WORD_SLOTS`` slots (square root of their share, so that texts of all lengths weigh
alike), structure statistics, and numeric metadata columns. Score: logistic of
w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2), which is linear in the number of features.

Training takes a sample of at most about ``SAMPLE`` labelled rows (chosen by a hash, whatever their number) in one
task; the model has a fixed size and is broadcast. Scoring reads whole texts and does not shuffle.

Nulls and ties: a null text is scored as an empty one, null metadata as 0, rows with null labels do not train. Repeated
rows are scored each. Without any labelled row every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .features import STATISTICS, hashed, statistics, text_chunks
from .workers import task

WORD_SLOTS = 1 << 16
RANK = 8
SAMPLE = 12_000
EPOCHS, RATE, DECAY = 8, 0.08, 2e-5


def _rows(batch: pa.RecordBatch, text: int, metadata: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word slots, word values, dense values) of each text."""
    extra = [np.log1p(np.abs(np.nan_to_num(batch.column(m).cast(pa.float64()).fill_null(0).to_numpy()))) for m in metadata]
    for lo, hi, data, ends, starts, lengths, bounds in text_chunks(batch.column(text)):
        words = hashed(data, starts, lengths)
        dense = statistics(data, ends, words, bounds)
        slots = (words >> np.uint64(16)).astype(np.int64) & (WORD_SLOTS - 1)
        for i in range(hi - lo):
            slot, times = np.unique(slots[bounds[i] : bounds[i + 1]], return_counts=True)
            value = np.sqrt(times / max(1, times.sum()))
            yield lo + i, slot, value, np.concatenate([dense[i], [e[lo + i] for e in extra]])


class Machine:
    """Weights: word slots first, then dense features; dense features are centred and scaled."""

    def __init__(self, dense: int):
        self.mean, self.scale = np.zeros(dense), np.ones(dense)
        self.w0 = 0.0
        self.w = np.zeros(WORD_SLOTS + dense)
        self.v = np.zeros((WORD_SLOTS + dense, RANK))

    def dense(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)

    def score(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Logits of rows whose word entries begin at ``starts``."""
        n, d = len(starts), self.dense(dense)
        ends = np.append(starts[1:], len(slots))
        some = np.flatnonzero(ends > starts)

        def summed(x: np.ndarray) -> np.ndarray:
            out = np.zeros((n, *x.shape[1:]))
            if len(some):
                out[some] = np.add.reduceat(x, starts[some])
            return out

        w, v = self.w[WORD_SLOTS:], self.v[WORD_SLOTS:]
        vx = self.v[slots] * values[:, None]
        total = summed(vx) + d @ v
        squares = summed(vx * vx) + (d * d) @ (v * v)
        linear = self.w0 + summed(self.w[slots] * values) + d @ w
        return linear + 0.5 * (total * total - squares).sum(1)

    def fit(self, slots: list, values: list, dense: np.ndarray, labels: np.ndarray) -> None:
        rng = np.random.default_rng(7)
        self.mean, self.scale = dense.mean(0), dense.std(0) + 1e-6
        self.v = rng.normal(0, 0.02, self.v.shape)
        d = self.dense(dense)
        places = np.arange(WORD_SLOTS, WORD_SLOTS + d.shape[1])
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        self.w0 = float(np.log(share / (1 - share)))
        gw, gv = np.full(self.w.shape, 1e-6), np.full(self.v.shape, 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for lo in range(0, len(order), 64):
                batch = order[lo : lo + 64]
                index = np.concatenate([np.concatenate([slots[i], places]) for i in batch])
                x = np.concatenate([np.concatenate([values[i], d[i]]) for i in batch])
                sizes = np.array([len(slots[i]) + len(places) for i in batch])
                starts = np.cumsum(sizes) - sizes
                vx = self.v[index] * x[:, None]
                total = np.add.reduceat(vx, starts)
                y = self.w0 + np.add.reduceat(self.w[index] * x, starts)
                y += 0.5 * ((total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
                slope = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[batch]) / len(batch)
                self.w0 -= RATE * float(slope.sum())
                each = np.repeat(slope, sizes) * x
                used, back = np.unique(index, return_inverse=True)
                step = np.bincount(back, each, len(used)) + DECAY * self.w[used]
                gw[used] += step * step
                self.w[used] -= RATE * step / np.sqrt(gw[used])
                pull = each[:, None] * (np.repeat(total, sizes, axis=0) - vx)
                step = np.stack([np.bincount(back, pull[:, f], len(used)) for f in range(RANK)], 1) + DECAY * self.v[used]
                gv[used] += step * step
                self.v[used] -= 0.5 * RATE * step / np.sqrt(gv[used])

    def packed(self) -> list[bytes]:
        return [
            x.astype(np.float64).tobytes() for x in (self.mean, self.scale, np.array([self.w0]))
        ] + [x.astype(np.float32).tobytes() for x in (self.w, self.v)]

    @classmethod
    def opened(cls, parts: list[bytes]) -> Machine:
        mean = np.frombuffer(parts[0])
        out = cls(len(mean))
        out.mean, out.scale, out.w0 = mean, np.frombuffer(parts[1]), float(np.frombuffer(parts[2])[0])
        out.w = np.frombuffer(parts[3], np.float32).astype(np.float64)
        out.v = np.frombuffer(parts[4], np.float32).astype(np.float64).reshape(-1, RANK)
        return out


def _featurise(metadata: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            out = [
                (float(labels[i]), s.astype(np.int32).tobytes(), x.astype(np.float32).tobytes(), d.tobytes())
                for i, s, x, d in _rows(batch, 0, list(range(2, 2 + metadata)))
            ]
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.float64(), *(pa.binary(),) * 3))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "slots", "counts", "dense"])

    return run


def _train(dense: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        machine = Machine(dense)
        if rows:
            machine.fit(
                [np.frombuffer(r[1], np.int32).astype(np.int64) for r in rows],
                [np.frombuffer(r[2], np.float32).astype(np.float64) for r in rows],
                np.stack([np.frombuffer(r[3]) for r in rows]),
                np.array([r[0] for r in rows]),
            )
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in machine.packed()], list("abcde"))

    return run


def hashed_sample(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows at most, picked by a hash of ``key``."""
    total = rows.count()
    if total <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1_000_000)) < int(1_000_000 * bound / total))


def train(docs: DataFrame, labels: DataFrame, label: str, metadata: tuple[str, ...] = (), sample: int = SAMPLE) -> list[bytes]:
    """The model, as bytes of fixed size. ``labels``: doc_id and ``label`` (1: good) of the rows to learn from."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = hashed_sample(known.select("doc_id", F.col(label).alias("__label")), F.col("doc_id"), sample)
    rows = docs.select("doc_id", "text", *metadata).join(F.broadcast(known), "doc_id")  # ``sample`` rows bound it
    rows = rows.select("text", "__label", *metadata)
    made = rows.mapInArrow(task(_featurise(len(metadata))), "label double, slots binary, counts binary, dense binary")
    model = made.repartition(1).mapInArrow(task(_train(STATISTICS + len(metadata))), "a binary, b binary, c binary, d binary, e binary")
    return [bytes(x) for x in model.first()]


def _score(model, text: int, metadata: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.opened(model.value)
        for batch in batches:
            scores, held = np.zeros(batch.num_rows), []

            def flush(scores=scores):
                sizes = np.array([len(h[1]) for h in held])
                logit = machine.score(
                    np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]),
                    np.cumsum(sizes) - sizes, np.stack([h[3] for h in held]),
                )
                scores[[h[0] for h in held]] = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
                held.clear()

            for row in _rows(batch, text, metadata):
                held.append(row)
                if len(held) == 200:
                    flush()
            if held:
                flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: list[bytes], metadata: tuple[str, ...] = (), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, and ``__score``: probability that the label is 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inputs = docs.select(*dict.fromkeys([*keep, "text", *metadata]))
    at = inputs.columns.index
    schema = StructType([*inputs.schema.fields, StructField("__score", DoubleType())])
    scored = inputs.mapInArrow(task(_score(shared, at("text"), [at(m) for m in metadata])), schema)
    return scored.select(*keep, "__score")

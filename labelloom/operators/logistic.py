"""Multinomial logistic regression over written byte n-grams, with bounded memory in every task.

Objective, standardization and optimizer are those of Spark ML's ``LogisticRegression``; Spark ML keeps all rows as blocks of doubles on the executors'
heaps, once for each fit. Here the sets of n-grams of a group of texts are one compressed row of Parquet (a *pack*), every evaluation is a pass over the packs, and
all fits that wait for one share it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lbfgs import minimize
from ..functions.ngrams import distinct_buckets
from ..session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

PACK_BYTES = 100_000  # of texts taken apart at a time: their n-grams stay in a core's cache
BLOCK = 1 << 19  # n-grams that a pass holds in numbers
STRIPES = 32  # of the places, in which partial sums travel
PACKS = "labels binary, counts binary, places binary"
GROUP_BYTES = 8 << 20  # of a Parquet row group, which its writer holds whole
_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "100",  # rows are texts or packs
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # partial sums of a pass are of no use after it
}


@contextmanager
def bounded_batches(spark: SparkSession):
    """Small batches of rows, for what runs inside; files of a shuffle go with it."""
    given = {name: spark.conf.get(name) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in given.items():
            spark.conf.set(name, value)


def hashing_slots(width: int) -> np.ndarray:
    """The place that ``HashingTF`` with ``width`` features gives each of the integers below ``width``."""
    h = np.arange(width, dtype=np.uint32) * np.uint32(0xCC9E2D51)
    h = ((h << np.uint32(15)) | (h >> np.uint32(17))) * np.uint32(0x1B873593) ^ np.uint32(42)
    h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32).astype(np.int64) % width


# --- packs ----------------------------------------------------------------------------------


def _packed(found: np.ndarray, n: np.ndarray, width: int) -> bytes:
    """Sorted places of one text after the other: differences over all texts that have any, in 2 or 4 bytes, which stand by rank (most high ones are zero)."""
    n = n[n > 0]
    keys = found + np.repeat(np.arange(len(n)) * width, n)
    steps = np.diff(keys, prepend=0)
    wide = 2 if not len(steps) or steps.max() < 1 << 16 else 4
    planes = steps.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T
    return bytes([wide]) + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: np.ndarray, width: int) -> np.ndarray:
    n = n[n > 0]
    size, wide = int(n.sum()), raw[0]
    planes = np.frombuffer(pa.decompress(raw[1:], wide * size, codec="zstd", asbytes=True), np.uint8).reshape(wide, size)
    keys = np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{wide}").ravel(), dtype=np.int64)
    keys -= np.repeat(np.arange(len(n)) * width, n)
    return keys


def written_packs(df: DataFrame, sizes: list[int], num_features: int) -> DataFrame:
    """Packs of ``label_idx`` and the places of the n-grams of ``text``, written to the shared folder: each text is read once."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    width = num_features * len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = hashing_slots(width)
        for batch in batches:
            labels = batch.column(0).to_numpy()
            for lo, hi, found, n in distinct_buckets(batch.column(1), sizes, num_features, slots=slots, chunk_bytes=PACK_BYTES):
                row = [labels[lo:hi].astype("<i4").tobytes(), n.astype("<i4").tobytes(), _packed(found, n, width)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], ["labels", "counts", "places"])

    rows = df.select(F.col("label_idx").cast("int").alias("label_idx"), "text")
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/packs-{uuid.uuid4().hex}"
    with bounded_batches(spark):
        packs = rows.mapInArrow(_tidy(run), PACKS)
        packs.write.options(**{"parquet.block.size": GROUP_BYTES, "compression": "uncompressed"}).parquet(path)
    return spark.read.schema(PACKS).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], width: int, least: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, numbers of places, places) of groups of texts with about ``least`` places."""
    held, size = [], 0
    for batch in batches:
        for labels, counts, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            n = np.frombuffer(counts, "<i4").astype(np.int64)
            held.append((np.frombuffer(labels, "<i4").astype(np.int64), n, _unpacked(raw, n, width)))
            size += len(held[-1][2])
            if size >= least:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def text_sums(weights: np.ndarray, n: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of the weights (columns x places) at the places of each text: columns x texts."""
    out = np.zeros((len(weights), len(n)))
    some = np.flatnonzero(n)
    if len(some):
        starts = (np.cumsum(n) - n)[some]
        for own, row in zip(out, weights, strict=True):
            own[some] = np.add.reduceat(row[places], starts)
    return out


def _tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, whose worker gives Arrow's memory back at the end."""

    def tidy(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return tidy


# --- passes -----------------------------------------------------------------------------------


def _totals(packs: DataFrame, partial: Callable[[Iterator], tuple[np.ndarray, np.ndarray]], columns: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all tasks of what ``partial`` makes of a task's blocks: a matrix (columns x width) and a short vector.

    A task for each core; its sums travel in stripes of the places, which are added up by stripe, so the driver gets one matrix.
    """
    span = -(-width // STRIPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, rest = partial(blocks(batches, width))
        part = TaskContext.get().partitionId()
        for k in range(STRIPES + 1):
            raw = rest.tobytes() if k == STRIPES else np.ascontiguousarray(matrix[:, k * span : (k + 1) * span]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([raw], pa.binary())], ["stripe", "part", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the stripes of a partition, which come one after the other."""
        now, total = None, None
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["stripe", "sums"])
                    now, total = k, np.zeros(len(raw) // 8)
                total += np.frombuffer(raw)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["stripe", "sums"])

    spark = packs.sparkSession
    with bounded_batches(spark):
        sums = packs.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(_tidy(run), "stripe int, part int, sums binary")
        dealt = sums.repartition("stripe").sortWithinPartitions("stripe", "part")
        found = dealt.mapInArrow(_tidy(added), "stripe int, sums binary").toArrow()
    matrix, rest = np.zeros((columns, width)), None
    for k, raw in zip(found.column(0).to_pylist(), found.column(1), strict=True):
        values = np.frombuffer(raw.as_buffer())
        if k == STRIPES:
            rest = values.copy()
        elif len(values):
            matrix[:, k * span : (k + 1) * span] = values.reshape(columns, -1)
    return matrix, rest


def _counts(packs: DataFrame, classes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each place, and texts of each class."""

    def partial(found: Iterator) -> tuple[np.ndarray, np.ndarray]:
        texts, labels = np.zeros((1, width)), np.zeros(classes)
        for label, _, places in found:
            texts[0] += np.bincount(places, minlength=width)
            labels += np.bincount(label, minlength=classes)
        return texts, labels

    texts, labels = _totals(packs, partial, 1, width)
    return texts[0], labels if labels is not None else np.zeros(classes)


def _turned(classes: int) -> np.ndarray:
    """Orthonormal directions (classes - 1) in which the classes add up to zero: all that a step can change. Lengths and products stay what they are."""
    out = np.zeros((classes - 1, classes))
    for i in range(1, classes):
        out[i - 1, :i], out[i - 1, i] = 1.0, -i
        out[i - 1] /= np.sqrt(i * (i + 1))
    return out


class _Objective:
    """Mean loss and its gradient at several points at once, in standardized and centred features.

    A point has the ``_turned`` classes as rows, the ``used`` places (those that tell texts apart) as columns and the intercepts last.
    """

    def __init__(self, packs: DataFrame, texts: np.ndarray, labels: np.ndarray):
        self.packs, self.rows, self.classes, self.width = packs, labels.sum(), len(labels), len(texts)
        spread = np.sqrt(texts * (self.rows - texts) / self.rows / max(self.rows - 1, 1))
        self.used = np.flatnonzero(spread > 0)
        self.scale = 1.0 / spread[self.used]
        self.mean = texts[self.used] / self.rows * self.scale
        self.turn = _turned(self.classes)

    def __call__(self, points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """Only differences to the last class matter, and the gradients of all classes add up to zero, so one class less is computed."""
        width, less, used, fits = self.width, self.classes - 1, self.used, len(points)
        apart = (self.turn[:, :-1] - self.turn[:, -1:]).T  # from a point to the differences
        weights, offsets = np.zeros((less * fits, width)), np.empty(less * fits)
        for at, x in enumerate(points):
            for k in range(less):
                row = apart[k] @ x
                offsets[at * less + k] = row[-1] - row[:-1] @ self.mean
                weights[at * less + k, used] = row[:-1] * self.scale
        sent = self.packs.sparkSession.sparkContext.broadcast((weights, offsets))
        del weights

        def partial(found: Iterator) -> tuple[np.ndarray, np.ndarray]:
            weights, offsets = sent.value
            sums, rest = np.zeros_like(weights), np.zeros(fits + fits * less)
            for label, n, places in found:
                margins, row = text_sums(weights, n, places) + offsets[:, None], np.arange(len(n))
                for fit in range(fits):
                    z = np.concatenate([margins[fit * less : (fit + 1) * less], np.zeros((1, len(n)))])
                    top = z.max(axis=0)
                    p = np.exp(z - top)
                    total = p.sum(axis=0)
                    rest[fit] += (np.log(total) + top - z[label, row]).sum()
                    p /= total
                    p[label, row] -= 1.0
                    for k in range(less):
                        sums[fit * less + k] += np.bincount(places, np.repeat(p[k], n), width)
                        rest[fits + fit * less + k] += p[k].sum()
            return sums, rest

        try:
            sums, rest = _totals(self.packs, partial, less * fits, width)
        finally:
            sent.destroy()
        out = []
        for at in range(fits):
            grad = np.empty((less, len(used) + 1))
            grad[:, -1] = rest[fits:][at * less : (at + 1) * less]
            for k in range(less):
                grad[k, :-1] = sums[at * less + k, used] * self.scale - grad[k, -1] * self.mean
            out.append((rest[at] / self.rows, apart.T @ grad / self.rows))
        return out


def fit(packs: DataFrame, classes: int, width: int, reg_params: tuple[float, ...], max_iter: int, tol: float = 1e-6) -> list[tuple[np.ndarray, np.ndarray]]:
    """(coefficients, intercepts) for each ``reg_param`` (L2 on standardized features), over the classes up to the last one that occurs."""
    texts, labels = _counts(packs, classes, width)
    if not labels.sum():
        raise ValueError("no rows to train on")
    labels = labels[: np.flatnonzero(labels)[-1] + 1]
    if (labels > 0).sum() == 1:
        only = np.where(labels > 0, np.inf, 0.0)
        return [(np.zeros((len(labels), width)), only) for _ in reg_params]
    objective = _Objective(packs, texts, labels)
    first = np.zeros((len(labels) - 1, len(objective.used) + 1))
    first[:, -1] = objective.turn @ np.log1p(labels)
    runs = [minimize(first.ravel(), max_iter, tol) for _ in reg_params]
    asked, ends = {at: next(run) for at, run in enumerate(runs)}, {}
    while asked:
        waiting = [(at, point.reshape(first.shape)) for at, point in asked.items()]
        answers, asked = objective([x for _, x in waiting]), {}
        for (at, x), (loss, grad) in zip(waiting, answers, strict=True):
            coefficients = x[:, :-1]
            grad[:, :-1] += reg_params[at] * coefficients
            try:
                asked[at] = runs[at].send((loss + reg_params[at] / 2 * float(np.einsum("ij,ij", coefficients, coefficients)), grad.ravel()))
            except StopIteration as end:
                ends[at] = end.value.reshape(first.shape)
    out = []
    for at in range(len(reg_params)):
        turned = objective.turn.T @ ends.pop(at)
        coefficients = np.zeros((len(labels), width))
        coefficients[:, objective.used] = turned[:, :-1] * objective.scale
        out.append((coefficients, turned[:, -1] - turned[:, :-1] @ objective.mean))
    return out

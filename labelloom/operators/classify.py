"""Byte n-gram text classifiers: count-based naive Bayes and multinomial logistic regression."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions.ngrams import distinct_buckets, ngram_lists
from ..functions.text import argmax, softmax
from ..session import ensure_checkpoint_dir
from .datasets import encode_labels
from .evaluate import log_loss
from .logistic import PACK_BYTES, blocks, bounded_batches, fit, hashing_slots, text_sums, written_packs

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

# --- scores to labels --------------------------------------------------------------------


def score_labels(df: DataFrame, classes: list[str], scores: str = "scores") -> DataFrame:
    """Add ``pred`` (first maximum) and ``confidence`` (softmax of that score)."""
    names = F.array(*[F.lit(c) for c in classes])
    best = argmax(F.col(scores))
    return df.withColumns(
        {"pred": F.get(names, best), "confidence": F.array_max(softmax(F.col(scores)))}
    )


# --- naive Bayes ----------------------------------------------------------------------------

MODEL_BYTES = 64_000_000  # of a weight matrix that one task holds; larger ones are cut into shards of buckets
SHARES = 16  # of the rows that meet a shard


@dataclass(frozen=True)
class NaiveBayes:
    """``counts``: (class, bucket, n), the rows of each class with the bucket. A weight is log(n + 1), so what is not there weighs nothing.

    ``matrix``: the weights as classes x buckets, broadcast, where they have ``MODEL_BYTES`` at most.
    """

    classes: list[str]
    sizes: list[int]
    buckets: int
    max_bytes: int | None
    counts: DataFrame
    rows: list[int]
    features: list[int]
    matrix: Broadcast | None
    shard_bytes: int

    @property
    def width(self) -> int:
        return self.buckets * len(self.sizes)

    def _constants(self) -> tuple[np.ndarray, np.ndarray]:
        """Log of the prior, and of the denominator, of each class."""
        total = sum(self.rows)
        prior = [math.log(n / total) if n else float("-inf") for n in self.rows]
        return np.array(prior), np.log(np.array(self.features, np.float64) + self.width)

    def scores(self, df: DataFrame) -> DataFrame:
        """Add ``scores``: ARRAY<DOUBLE> of log likelihood plus log prior, in class order; null for a null text.

        A projection without a shuffle, also on streams, as long as the matrix is broadcast. A larger model meets the rows in shards of
        buckets: the rows are written once (checkpoint), their buckets and the weights dealt by shard and partial sums added.
        """
        return self._in_place(df) if self.matrix is not None else self._by_shard(df)

    def _in_place(self, df: DataFrame) -> DataFrame:
        sizes, buckets, max_bytes, matrix = self.sizes, self.buckets, self.max_bytes, self.matrix
        prior, norm = self._constants()

        @F.arrow_udf("array<double>")
        def run(column: pa.Array) -> pa.Array:
            out = np.zeros((len(column), len(prior)))
            for lo, hi, found, n in distinct_buckets(column, sizes, buckets, max_bytes):
                row = np.repeat(np.arange(hi - lo), n)
                for i, weights in enumerate(matrix.value):
                    out[lo:hi, i] = np.bincount(row, weights[found], hi - lo) - n * norm[i] + prior[i]
            return _score_lists(out, column.is_null().to_numpy(zero_copy_only=False))

        return df.withColumn("scores", run(F.col("text")))

    def _by_shard(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        written = df.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
        classes, sizes, buckets, max_bytes = len(self.classes), self.sizes, self.buckets, self.max_bytes
        span = max(1, self.shard_bytes // (8 * classes))  # buckets of a shard
        schema = "shard long, share int, kind int, id long, class int, bucket int, n long, buckets binary"

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The buckets of each text, cut by shard."""
            for batch in batches:
                ids = batch.column(0).to_numpy()
                for lo, hi, found, n in distinct_buckets(batch.column(1), sizes, buckets, max_bytes):
                    key = np.repeat(np.arange(lo, hi), n) * (2**32) + found // span  # texts and shards come in order
                    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                    raw, bounds = found.astype(np.int32).tobytes(), 4 * np.append(first, len(found))
                    own = ids[key[first] >> 32]
                    size = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[first] & 0xFFFFFFFF), pa.array((own % SHARES).astype(np.int32)), pa.array(np.ones(size, np.int32)),
                            pa.array(own), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int64()),
                            pa.array([raw[bounds[k] : bounds[k + 1]] for k in range(size)], pa.binary()),
                        ],
                        ["shard", "share", "kind", "id", "class", "bucket", "n", "buckets"],
                    )

        def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Partial sums of the texts of a share; the weights of their shard come before them."""
            weights, now = np.zeros((classes, span)), None
            for batch in batches:
                shard, share, kind = (batch.column(k).to_numpy() for k in range(3))
                at = np.flatnonzero(np.append(True, (np.diff(shard) != 0) | (np.diff(share) != 0) | (np.diff(kind) != 0)))
                for lo, hi in zip(at, np.append(at[1:], batch.num_rows), strict=True):
                    if (shard[lo], share[lo]) != now:
                        now = (shard[lo], share[lo])
                        weights[:] = 0
                    part = batch.slice(lo, hi - lo)
                    if kind[lo] == 0:
                        weights[part.column(4).to_numpy(), part.column(5).to_numpy() - now[0] * span] = np.log(part.column(6).to_numpy() + 1.0)
                        continue
                    sums, seen = [], []
                    for raw in part.column(7).to_pylist():
                        found = np.frombuffer(raw, np.int32) - now[0] * span
                        sums.append(weights[:, found].sum(axis=1).tobytes())
                        seen.append(len(found))
                    yield pa.RecordBatch.from_arrays([part.column(3), pa.array(seen, pa.int64()), pa.array(sums, pa.binary())], ["id", "n", "sums"])

        prior, norm = self._constants()

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Scores of the ids of a partition, whose partial sums come one after the other."""
            now, total, seen = None, np.zeros(classes), 0

            def done() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), _score_lists((total - seen * norm + prior)[None])], ["id", "scores"])

            for batch in batches:
                for i, n, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if i != now:
                        if now is not None:
                            yield done()
                        now, total, seen = i, np.zeros(classes), 0
                    total = total + np.frombuffer(raw)
                    seen += n
            if now is not None:
                yield done()

        asked = written.select("__id", "text").mapInArrow(dealt, schema)
        shares = F.explode(F.array(*[F.lit(k) for k in range(SHARES)]))
        model = self.counts.select(
            F.floor(F.col("bucket") / span).alias("shard"), shares.alias("share"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"),
            "class", "bucket", "n", F.lit(None).cast("binary").alias("buckets"),
        )
        order = ["shard", "share", "kind"]
        sums = asked.unionByName(model).repartition("shard", "share").sortWithinPartitions(*order).mapInArrow(met, "id long, n long, sums binary")
        scores = sums.repartition("id").sortWithinPartitions("id").mapInArrow(added, "id long, scores array<double>")
        empty = F.when(F.col("text").isNotNull(), F.array(*[F.lit(float(x)) for x in prior]))  # texts without n-grams
        joined = written.join(scores, F.col("__id") == F.col("id"), "left").drop("id", "__id")
        return joined.withColumn("scores", F.coalesce("scores", empty))

    def predict(self, df: DataFrame) -> DataFrame:
        return score_labels(self.scores(df), self.classes)


def _score_lists(rows: np.ndarray, nulls: np.ndarray | None = None) -> pa.Array:
    """A list for each row; null and without values where ``nulls`` says so."""
    if nulls is None or not nulls.any():
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
    bounds = np.concatenate([[0], np.cumsum(~nulls * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, mask=np.append(nulls, False)), pa.array(rows[~nulls].ravel()))


def _class_counts(classes: list[str], sizes: list[int], buckets: int, max_bytes: int | None):
    """(class, bucket, n) of the rows of a task; bucket -1 counts the rows of the class."""
    index, width = {c: i for i, c in enumerate(classes)}, buckets * len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.bincount(n, np.concatenate([n for _, n in held]).astype(np.float64), len(keys)).astype(np.int64)
            columns = [(keys // (width + 1)).astype(np.int32), (keys % (width + 1) - 1).astype(np.int32), sums]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["class", "bucket", "n"])

        for batch in batches:
            label = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64) * (width + 1)
            held.append(np.unique(label, return_counts=True))
            for lo, hi, found, n in distinct_buckets(batch.column(1), sizes, buckets, max_bytes):
                held.append(np.unique(np.repeat(label[lo:hi], n) + found + 1, return_counts=True))
                amount += len(held[-1][0])
            if amount > COUNTS_HELD:
                one = counted()
                keys = one.column(0).to_numpy().astype(np.int64) * (width + 1) + one.column(1).to_numpy() + 1
                held, amount = [(keys, one.column(2).to_numpy())], 0
                if len(keys) > COUNTS_HELD // 2:
                    yield one
                    held = []
        if held:
            yield counted()

    return run


COUNTS_HELD = 4_000_000  # counts of a task before they are added up


def train_naive_bayes(
    df: DataFrame,
    classes: list[str],
    sizes: list[int] | None = None,
    buckets: int = 65_536,
    max_bytes: int | None = None,
    model_bytes: int = MODEL_BYTES,
) -> NaiveBayes:
    """Counts of present features per class, add-one smoothing over all buckets, in one pass over ``df``.

    The counts are checkpointed, so scoring never repeats the training. No row and no task holds the whole model
    when it has more than ``model_bytes``.
    """
    sizes, classes = list(sizes or fv.NGRAM_SIZES), list(classes)
    ensure_checkpoint_dir(df.sparkSession)
    known = df.filter(F.col("label").isin(*classes)).select("label", "text")
    counts = known.mapInArrow(_class_counts(classes, sizes, buckets, max_bytes), "class int, bucket int, n long")
    counts = counts.groupBy("class", "bucket").agg(F.sum("n").alias("n")).checkpoint()  # at most classes x (buckets + 1) rows
    rows, features = [0] * len(classes), [0] * len(classes)
    is_row = F.col("bucket") < 0
    totals = counts.groupBy("class").agg(F.sum(F.when(is_row, F.col("n"))).alias("rows"), F.sum(F.when(~is_row, F.col("n"))).alias("features"))
    for r in totals.collect():  # one row per class
        rows[r["class"]], features[r["class"]] = r["rows"] or 0, r["features"] or 0
    counts, matrix = counts.filter(~is_row), None
    width = buckets * len(sizes)
    if 8 * width * len(classes) <= model_bytes:
        weights = np.zeros((len(classes), width))
        found = counts.toArrow()
        weights[found.column("class").to_numpy(), found.column("bucket").to_numpy()] = np.log(found.column("n").to_numpy() + 1.0)
        matrix = df.sparkSession.sparkContext.broadcast(weights)
    return NaiveBayes(classes, sizes, buckets, max_bytes, counts, rows, features, matrix, model_bytes)


# --- logistic regression --------------------------------------------------------------------


@dataclass(frozen=True)
class Logistic:
    """``weights``: coefficients (classes x places of the n-grams) and intercepts, broadcast."""

    classes: list[str]
    sizes: list[int]
    num_features: int
    weights: Broadcast
    history: list[tuple[float, float, float]]  # (reg_param, val_loss, val_accuracy)

    @property
    def width(self) -> int:
        return self.num_features * len(self.sizes)

    def scores(self, df: DataFrame) -> DataFrame:
        """Add ``scores``: ARRAY<DOUBLE> of log odds in class order; null for a null text. The n-grams of a text stay with the worker."""
        sizes, num_features, width, weights = self.sizes, self.num_features, self.width, self.weights

        @F.arrow_udf("array<double>")
        def run(column: pa.Array) -> pa.Array:
            (coefficients, intercepts), slots = weights.value, hashing_slots(width)
            out = np.zeros((len(column), len(intercepts)))
            for lo, hi, found, n in distinct_buckets(column, sizes, num_features, slots=slots, chunk_bytes=PACK_BYTES):
                out[lo:hi] = text_sums(coefficients, n, found).T + intercepts
            return _score_lists(out, column.is_null().to_numpy(zero_copy_only=False))

        return df.withColumn("scores", run(F.col("text")))

    def pack_scores(self, packs: DataFrame) -> DataFrame:
        """``label_idx`` and ``scores`` of the texts of ``packs``."""
        width, weights = self.width, self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coefficients, intercepts = weights.value
            for labels, n, places in blocks(batches, width):
                scores = text_sums(coefficients, n, places).T + intercepts
                yield pa.RecordBatch.from_arrays([pa.array(labels.astype(np.int32)), _score_lists(scores)], ["label_idx", "scores"])

        return packs.mapInArrow(run, "label_idx int, scores array<double>")

    def predict(self, df: DataFrame) -> DataFrame:
        """Stateless: works on a batch table and on a stream."""
        return score_labels(self.scores(df), self.classes)


def _vectors(df: DataFrame, sizes: list[int], num_features: int) -> DataFrame:
    grams = ngram_lists(F.col("text"), sizes, num_features)
    # a slot space per size, so that n-grams of different sizes do not share slots by design
    tf = HashingTF(inputCol="__grams", outputCol="features", numFeatures=num_features * len(sizes), binary=True)
    return tf.transform(df.withColumn("__grams", grams))


_SPARSE = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def written_vectors(df: DataFrame, sizes: list[int], num_features: int) -> DataFrame:
    """``label_idx`` and the ``features`` of ``_vectors``, for estimators of Spark ML: made from written packs, so each text is read once, however
    often the vectors are."""
    width = num_features * len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, n, places in blocks(batches, width, 1):
            bounds, rows = pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), len(n)
            columns = [
                pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)),
                pa.ListArray.from_arrays(bounds, pa.array(places.astype(np.int32))),
                pa.ListArray.from_arrays(bounds, pa.array(np.ones(len(places)))),
            ]
            vectors = pa.StructArray.from_arrays(columns, fields=list(_SPARSE))
            yield pa.RecordBatch.from_arrays([pa.array(labels.astype(np.int32)), vectors], ["label_idx", "features"])

    schema = T.StructType([T.StructField("label_idx", T.IntegerType()), T.StructField("features", VectorUDT())])
    return written_packs(df, sizes, num_features).mapInArrow(run, schema)


def train_logistic(
    train: DataFrame,
    val: DataFrame,
    classes: DataFrame,
    reg_params: tuple[float, ...] = (0.01, 0.1),
    max_iter: int = 20,
    sizes: list[int] | None = None,
    num_features: int = 1 << 16,
) -> Logistic:
    """One model per ``reg_param``; the first with the smallest validation loss is kept.

    The n-grams of both tables are made once and written; all models are fitted in the same passes over them.
    """
    spark, sizes = train.sparkSession, list(sizes or fv.NGRAM_SIZES)
    names = [r["label"] for r in classes.orderBy("idx").collect()]  # the class list
    fit_on = written_packs(encode_labels(train, classes), sizes, num_features)
    held_out = written_packs(encode_labels(val, classes), sizes, num_features)
    best, history = None, []
    for reg, found in zip(reg_params, fit(fit_on, len(names), num_features * len(sizes), reg_params, max_iter), strict=True):
        candidate = Logistic(names, sizes, num_features, spark.sparkContext.broadcast(found), [])
        with bounded_batches(spark):
            row = log_loss(candidate.pack_scores(held_out), "scores").first()
        history.append((reg, row["loss"], row["accuracy"]))
        if best is None or row["loss"] < best[0]:
            best = (row["loss"], candidate)
    return Logistic(names, sizes, num_features, best[1].weights, history)


# --- batch prediction with a user's model --------------------------------------------------------


def predict_batches(
    df: DataFrame, fn: Callable[[list[str]], list], batch: int = fv.SCORE_BATCH, key: str = "record_id"
) -> DataFrame:
    """``fn`` maps a list of at most ``batch`` texts to their labels; output ``key, pred``."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, pred string"

    def run(frames):
        for pdf in frames:
            for start in range(0, len(pdf), batch):
                part = pdf.iloc[start : start + batch]
                preds = [None if p is None else str(p) for p in fn(part["text"].tolist())]
                yield part[[key]].assign(pred=preds)

    return df.select(key, "text").mapInPandas(run, schema)


def step_scorer(predict: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Turn ``predict`` (adds ``pred``, ``confidence``) into the score function of a route step."""

    def score(df: DataFrame) -> DataFrame:
        out = predict(df)
        keep = [c for c in df.columns if c not in ("label", "confidence")]
        return out.select(*keep, F.col("pred").alias("label"), F.col("confidence"))

    return score


def unavailable(df: DataFrame) -> DataFrame:
    """Score function of a classifier that is not there: every row falls through."""
    return df.withColumns({"label": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})


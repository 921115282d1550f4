"""Byte n-grams in Arrow batches and naive Bayes in shards, against plain versions."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelloom.functions import ngrams
from labelloom.functions import text as tx
from labelloom.operators import classify as cf


def plain_buckets(text, sizes, buckets, max_bytes=None):
    raw = text.encode()[:max_bytes]
    return sorted(
        {int.from_bytes(raw[i : i + n], "big") % buckets + k * buckets for k, n in enumerate(sizes) for i in range(len(raw) - n + 1)}
    )


TEXTS = ["", "a", "abcabc", "가나다 é 😀" * 3, "x" * 700, None, "a\x00b\x00", "tail"]


@pytest.mark.parametrize("chunk, max_bytes", [(1_000_000, None), (5, None), (40, 6)])
def test_bucket_lists(monkeypatch, chunk, max_bytes):
    monkeypatch.setattr(ngrams, "CHUNK_BYTES", chunk)
    column = pa.array(["skipped", *TEXTS, "skipped"]).slice(1, len(TEXTS))
    for sizes, buckets in (([3, 4, 5, 6], 1000), ([2], 7), ([4, 1], 65_536)):
        got = ngrams.bucket_lists(column, sizes, buckets, max_bytes)
        assert got.to_pylist() == [None if t is None else plain_buckets(t, sizes, buckets, max_bytes) for t in TEXTS]
    assert ngrams.bucket_lists(pa.array([], pa.string()), [3], 10).to_pylist() == []
    assert ngrams.bucket_lists(pa.array([None], pa.string()), [3], 10).to_pylist() == [None]
    with pytest.raises(ValueError):
        ngrams.bucket_lists(column, [7], 10)


def test_lists_have_the_buckets_of_the_expression(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for a, b in df.select(F.sort_array(tx.ngram_buckets(F.col("text"), [3, 5], 500)), ngrams.ngram_lists(F.col("text"), [3, 5], 500)).collect():
        assert a == b


def records(seed, classes=5):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choices("abcde"[: 2 + i % 4] + " ", k=rng.randrange(60))), f"c{i % (classes + 1)}") for i in range(120)]
    return [*rows, (200, "", "c1"), (201, None, "c2"), (202, "zz", None)]


def plain_scores(rows, classes, sizes, buckets, text):
    counts = {c: Counter() for c in classes}
    for _, t, label in rows:
        if label in counts:
            counts[label].update(plain_buckets(t or "", sizes, buckets))
    size = Counter(label for _, _, label in rows if label in counts)
    own, total, out = plain_buckets(text, sizes, buckets), sum(size.values()), []
    for c in classes:
        norm = math.log(sum(counts[c].values()) + buckets * len(sizes))
        out.append(sum(math.log(counts[c][b] + 1) - norm for b in own) + (math.log(size[c] / total) if size[c] else -math.inf))
    return out


@pytest.mark.parametrize("model_bytes", [1 << 30, 8 * 6 * 100, 1])
def test_naive_bayes_whole_and_in_shards(spark, monkeypatch, model_bytes):
    """One matrix, shards of 100 buckets, and shards of one bucket."""
    rows, classes, sizes, buckets = records(1), [f"c{i}" for i in range(5)] + ["empty"], [1, 2], 60 if model_bytes == 1 else 300
    df = spark.createDataFrame(rows, "record_id long, text string, label string").repartition(3)
    model = cf.train_naive_bayes(df, classes, sizes, buckets, model_bytes=model_bytes)
    assert (model.matrix is None) == (model_bytes < 1 << 30)
    got = {r.record_id: r.scores for r in model.scores(df).collect()}
    assert len(got) == len(rows) and got.pop(201) is None
    for i, text, _ in rows:
        if i != 201:
            assert got[i] == pytest.approx(plain_scores(rows, classes, sizes, buckets, text), rel=1e-9)
    assert model.predict(df.limit(0)).collect() == []


def test_counts_are_added_up_within_a_task(spark, monkeypatch):
    rows, classes = records(2), ["c0", "c1"]
    df = spark.createDataFrame(rows, "record_id long, text string, label string").repartition(2)
    whole = cf.train_naive_bayes(df, classes, [2], 500)
    monkeypatch.setattr(cf, "COUNTS_HELD", 20)
    small = cf.train_naive_bayes(df, classes, [2], 500)
    assert sorted(map(tuple, whole.counts.collect())) == sorted(map(tuple, small.counts.collect()))
    assert (whole.rows, whole.features) == (small.rows, small.features)


def test_a_thousand_classes_stay_in_shards(spark):
    """No row of the model and no task's matrix grows with classes x buckets."""
    rows = [(i, f"text of class {i % 1000}", f"k{i % 1000}") for i in range(2_000)]
    df = spark.createDataFrame(rows, "record_id long, text string, label string").repartition(4)
    model = cf.train_naive_bayes(df, [f"k{i}" for i in range(1000)], [3, 4], 2048, model_bytes=1_000_000)
    assert model.matrix is None and model.shard_bytes // (8 * 1000) == 125
    some = model.predict(df.filter("record_id < 40")).collect()
    assert len(some) == 40 and all(len(r.scores) == 1000 for r in some)
    assert sum(r.pred == r.label for r in some) >= 38

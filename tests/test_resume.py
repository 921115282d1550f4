"""Resuming: rows that are not done yet, by digests and a filter of bounded size."""

import random
from collections import Counter

import pytest

from labelloom.operators import datasets as ds
from labelloom.operators import digests

from tests.conftest import plan


@pytest.mark.parametrize("bits", [1 << 20, 1 << 15])  # the small filter is full: most rows are held by mistake
def test_pending(spark, monkeypatch, bits):
    monkeypatch.setattr(digests, "FEWEST_BITS", bits)
    monkeypatch.setattr(digests, "MOST_BITS", bits)
    rng = random.Random(bits)
    texts = [f"text {rng.randrange(9_000)}" for _ in range(6_000)] + ["", "é", None, None]
    done = [f"text {i}" for i in range(0, 30_000, 2)] + ["é", None, "é"]
    samples = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string").repartition(3)
    finished = spark.createDataFrame([(t,) for t in done], "original_text string")
    known = {t for t in done if t is not None}
    got = ds.pending(samples, finished)
    assert got.columns == samples.columns
    assert Counter(map(tuple, got.collect())) == Counter((i, t) for i, t in enumerate(texts) if t not in known)


def test_texts_are_not_shuffled(spark):
    samples = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "record_id long, text string")
    finished = spark.createDataFrame([(f"t{i}",) for i in range(0, 50, 3)], "original_text string")
    shown = plan(ds.pending(samples, finished)).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning(text" not in shown and "SortMergeJoin [text" not in shown
    assert ds.pending(samples, finished.limit(0)).count() == 50 and ds.pending(samples.limit(0), finished).count() == 0

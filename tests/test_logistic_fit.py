"""Logistic regression over packs of n-grams against Spark ML, and its optimizer."""

import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression

from labelloom.functions import lbfgs, ngrams
from labelloom.operators import classify as cf
from labelloom.operators import datasets as ds
from labelloom.operators import logistic as lg
from tests.conftest import ROOT, plan

CLASSES = ["a", "b", "c", "never"]


def texts(spark, n=90, seed=3):
    rng = random.Random(seed)
    rows = [(i, "=" + "".join(rng.choices("abcdefgh"[i % 3 :] + "  ", k=rng.randrange(40))), CLASSES[i % 3]) for i in range(n)]
    rows += [(n + i, t, "b") for i, t in enumerate(["", "=", "", "가나다 é"])]
    return spark.createDataFrame(rows, "record_id long, text string, label string").repartition(3)


@pytest.mark.parametrize("features, sizes, steps", [(256, [1, 2, 3], 25), (3, [1, 2], 8)])
def test_models_are_those_of_spark_ml(spark, monkeypatch, features, sizes, steps):
    """A place in (nearly) all texts, texts without places, a class without rows; packs of a few texts; fewer places than stripes."""
    monkeypatch.setattr(lg, "PACK_BYTES", 200)
    monkeypatch.setattr(lg, "BLOCK", 500)
    rows, regs = ds.encode_labels(texts(spark), ds.classes_table(spark, CLASSES)), (0.01, 0.0, 3.0)
    passes = []
    asked = lg._Objective.__call__
    monkeypatch.setattr(lg._Objective, "__call__", lambda self, points: passes.append(len(points)) or asked(self, points))
    got = lg.fit(lg.written_packs(rows, sizes, features), len(CLASSES), features * len(sizes), regs, steps)
    assert passes[0] == 3 and sum(passes) > len(passes)  # the three share passes
    vectors = cf._vectors(rows, sizes, features).select("label_idx", "features").cache()
    for reg, (coefficients, intercepts) in zip(regs, got, strict=True):
        model = LogisticRegression(family="multinomial", labelCol="label_idx", featuresCol="features", regParam=reg, maxIter=steps).fit(vectors)
        assert coefficients == pytest.approx(model.coefficientMatrix.toArray(), rel=1e-4, abs=1e-6)
        assert intercepts == pytest.approx(model.interceptVector.toArray(), rel=1e-4, abs=1e-6)
    vectors.unpersist()


def test_one_label_and_none(spark):
    classes = ds.classes_table(spark, CLASSES)
    rows = ds.encode_labels(texts(spark).filter("label = 'b'"), classes)
    ((coefficients, intercepts),) = lg.fit(lg.written_packs(rows, [2], 16), 4, 16, (0.1,), 5)
    assert not coefficients.any() and list(intercepts) == [0.0, np.inf]
    with pytest.raises(ValueError):
        lg.fit(lg.written_packs(rows.limit(0), [2], 16), 4, 16, (0.1,), 5)


def test_scores_of_texts_and_packs(spark):
    """No list of n-grams is in the rows; a text that is not there has no scores."""
    rows, classes = texts(spark), ds.classes_table(spark, CLASSES)
    model = cf.train_logistic(rows, rows, classes, (0.1, 0.01), 5, [1, 2], 128)
    scored = model.scores(rows)
    assert "__grams" not in plan(scored) and "HashingTF" not in plan(scored)
    coefficients, intercepts = model.weights.value
    slots = lg.hashing_slots(256)
    for r in scored.collect():
        raw = r.text.encode()
        own = {slots[int.from_bytes(raw[i : i + n], "big") % 128 + 128 * (n - 1)] for n in (1, 2) for i in range(len(raw) - n + 1)}
        assert r.scores == pytest.approx(coefficients[:, sorted(own)].sum(axis=1) + intercepts)
    packs = lg.written_packs(ds.encode_labels(rows, classes), [1, 2], 128)
    by_pack = sorted((r.label_idx, *np.round(r.scores, 9)) for r in model.pack_scores(packs).collect())
    assert by_pack == sorted((CLASSES.index(r.label), *np.round(r.scores, 9)) for r in scored.collect())
    gone = spark.createDataFrame([(1, None)], "record_id long, text string")
    assert model.predict(gone).first()["scores"] is None


def test_packs_hold_what_they_were_given():
    rng = np.random.default_rng(5)
    for width in (1, 7, 1 << 20, 1 << 31):
        sets = [np.unique(rng.integers(0, width, rng.integers(0, 9) * rng.integers(0, 2))) for _ in range(200)]
        n = np.array([len(x) for x in sets])
        assert (lg._unpacked(lg._packed(np.concatenate(sets), n, width), n, width) == np.concatenate(sets)).all()
    assert len(lg._unpacked(lg._packed(np.zeros(0, np.int64), np.zeros(3, np.int64), 9), np.zeros(3, np.int64), 9)) == 0
    assert lg.text_sums(np.ones((2, 4)), np.array([0, 2, 0]), np.array([1, 3])).tolist() == [[0, 2, 0]] * 2
    assert list(lg.blocks(iter([pa.RecordBatch.from_pylist([], pa.schema([("labels", pa.binary())] * 3))]), 4)) == []


def test_minimizer_finds_a_curved_valley():
    """Rosenbrock's function from its usual start, where steps are cut and stretched."""

    def value(x):
        f = (1 - x[0]) ** 2 + 100 * (x[1] - x[0] ** 2) ** 2
        return f, np.array([-2 * (1 - x[0]) - 400 * x[0] * (x[1] - x[0] ** 2), 200 * (x[1] - x[0] ** 2)])

    run = lbfgs.minimize(np.array([-1.2, 1.0]), 200, 1e-12)
    x = next(run)
    with pytest.raises(StopIteration) as end:
        while True:
            x = run.send(value(x))
    assert end.value.value == pytest.approx([1.0, 1.0], abs=1e-5)


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, sys.argv[1])  # of this process; its Python workers do not get it
from labelloom.session import build_session
import __spark_entry__
conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": sys.argv[2], "spark.checkpoint.dir": sys.argv[2]}
spark = build_session("plain workers", "local[2]", **conf)
for name in ("logistic_facts", "naive_bayes"):
    print(name, __spark_entry__.queries()[name](spark, sys.argv[3]).count())
spark.stop()
"""


def test_workers_need_no_copy_of_the_package(sf_dir, tmp_path):
    kept = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    out = subprocess.run(
        [sys.executable, "-c", WITHOUT_PACKAGE, ROOT, str(tmp_path), sf_dir], cwd=tmp_path, env=kept, capture_output=True, text=True, timeout=300
    )
    assert "logistic_facts 4" in out.stdout and "naive_bayes " in out.stdout, out.stderr[-3000:]


@pytest.mark.parametrize("sizes, buckets", [([3, 4, 5, 6], 1000), ([2, 5], 1024), ([1], 3)])
def test_marked_buckets_are_the_sorted_ones(monkeypatch, sizes, buckets):
    """Long texts mark their buckets in a table, others are sorted."""
    rng = random.Random(9)
    column = pa.array(["".join(rng.choices("abcé가 ", k=k)) for k in (700, 0, 3, 1, 900, 2, 0)] + [None])
    slots = np.random.default_rng(1).permutation(buckets * len(sizes))
    marked = [x for _, _, *x in ngrams.distinct_buckets(column, sizes, buckets, slots=slots, chunk_bytes=800)]
    monkeypatch.setattr(ngrams, "MARKS", 0)
    monkeypatch.setattr(ngrams, "_marked", None)
    for got, want in zip(marked, [x for _, _, *x in ngrams.distinct_buckets(column, sizes, buckets, slots=slots, chunk_bytes=800)], strict=True):
        assert all((a == b).all() for a, b in zip(got, want, strict=True))

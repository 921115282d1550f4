import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import ball_tree, neighbours, vectors


def rows(seed=0, n=700, width=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    x[50:80] = x[50]  # ties
    x[300:320] *= 1e-4
    out = [(i, [float(v) for v in x[i]]) for i in range(n)]
    out[7] = (7, None)
    out[8] = (8, [])
    out[9] = (9, [None, *out[9][1][1:]])
    out[11] = (11, [float("nan"), *out[11][1][1:]])
    out[12] = (12, [float("inf"), *out[12][1][1:]])
    out[20] = (20, [0.0] * width)
    out += [(40, out[40][1]), (None, out[41][1]), (900, [1.0, 2.0]), (1000, [2.0, 1.0])]
    return out


def table(spark, data):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit(1) for c in ("id", "vector", "width", "block", "rank", "score")}).repartition(3)


def wanted(data, every, k, turn, zero, score):
    kept = {}
    for i, v in data:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v)):
            kept.setdefault(i, turn(np.array(v, np.float32).astype(float)))
    out = {}
    for q, x in kept.items():
        if q % every == 0:
            best = sorted((-score(x, y), i) for i, y in kept.items() if i != q and len(y) == len(x))[:k]
            out[q] = [(i, -s) for s, i in best]
    return {q: b for q, b in out.items() if b}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def plain(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


@pytest.mark.parametrize("block", [4096, 64])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    data = rows()
    got = found(neighbours.nearest(table(spark, data), F.col("id") % 20 == 0, 20))
    assert got == wanted(data, 20, 20, lambda x: x, False, plain)


@pytest.mark.parametrize("block", [4096, 64])
def test_ball_tree(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(ball_tree, "LEAF", 8)
    data = rows(1)
    got = found(ball_tree.top_inner_products(table(spark, data), F.col("id") % 50 == 0, 5))
    assert got == wanted(data, 50, 5, lambda x: np.floor(256 * x).astype(int), True, lambda x, y: int(x @ y))


def test_small_and_empty(spark):
    two = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert found(neighbours.nearest(table(spark, two), F.col("id") % 20 == 0, 20)) == {0: [(1, 0.5)]}
    assert found(ball_tree.top_inner_products(table(spark, two), F.col("id") % 50 == 0, 5)) == {0: [(1, 128 * 256)]}
    assert found(neighbours.nearest(table(spark, []), F.col("id") % 20 == 0, 20)) == {}
    assert found(ball_tree.top_inner_products(table(spark, []), F.col("id") % 50 == 0, 5)) == {}


@pytest.mark.parametrize("block", [4096, 64])
def test_negative_ids(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    data = [(None if i is None else i - 350, v) for i, v in rows(2)]
    got = found(neighbours.nearest(table(spark, data), F.col("id") % 20 == 0, 20))
    assert got == wanted(data, 20, 20, lambda x: x, False, plain)
    got = found(ball_tree.top_inner_products(table(spark, data), F.col("id") % 50 == 0, 5))
    assert got == wanted(data, 50, 5, lambda x: np.floor(256 * x).astype(int), True, lambda x, y: int(x @ y))

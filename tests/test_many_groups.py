"""First k rows with more groups than are looked at together, and completions with tied numbers."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.operators import datasets as ds
from labelloom.operators import scale
from labelloom.operators import supervise as sv


def test_one_large_group_among_many(spark, monkeypatch):
    """60,000 groups of which one is large: it alone is narrowed until few rows are left to order."""
    monkeypatch.setattr(scale, "EDGE_ROWS", 1_000)
    large = spark.range(150_000).select(F.lit(7).cast("long").alias("g"), (F.col("id") * 7919 % 150_011).alias("at"))
    small = spark.range(180_000).select((F.col("id") % 60_000).alias("g"), (F.col("id") * 31 % 1_009).alias("at"))
    df = large.unionByName(small)
    seen = []
    inside = scale._inside

    def counted(keyed, groups, keys):
        out = inside(keyed, groups, keys)
        seen.append(out.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0)
        return out

    monkeypatch.setattr(scale, "_inside", counted)
    cuts = {r.g: r for r in scale.cutoffs(df, ["g"], [F.col("at")], quota=lambda n: F.floor(n / 2)).collect()}
    assert len(cuts) == 60_000 and max(seen) <= 1_000
    rows = sorted(r.at for r in df.filter("g = 7").collect())
    assert cuts[7].cut.o0 == rows[len(rows) // 2 - 1]
    some = {g: sorted(g_at for _, g_at in [(i % 60_000, i * 31 % 1_009) for i in (g, g + 60_000, g + 120_000)]) for g in (0, 8, 59_999)}
    assert all(cuts[g].cut.o0 == at[0] for g, at in some.items())


@pytest.mark.parametrize("limit", [50_000, 0])
def test_caps_agree_however_many_groups_are_looked_at(spark, monkeypatch, limit):
    rng = random.Random(5)
    data = [(i, f"t{rng.randrange(40)}", f"c{min(rng.randrange(30), 9)}") for i in range(2_000)]
    data += [(-1, "same", "c9")] * 300  # equal rows around the cut
    df = spark.createDataFrame(data, "record_id long, text string, label string").repartition(3)
    need = spark.createDataFrame([(f"c{k}", 40 * k) for k in range(10)], "label string, need long")
    want = Counter(map(tuple, ds.cap_per_class(df, need, order=["record_id"]).collect()))
    monkeypatch.setattr(scale, "EDGE_ROWS", 20)
    copy = scale.local_copy
    monkeypatch.setattr(scale, "local_copy", lambda d, n=limit: copy(d, n))
    assert Counter(map(tuple, ds.cap_per_class(df, need, order=["record_id"]).collect())) == want
    assert sum(want.values()) == sum(min(40 * k, Counter(c for _, _, c in data)[f"c{k}"]) for k in range(10))


def test_tied_completions_give_what_is_needed(spark):
    lines = ["one\ntwo\nthree", "four\nfive\nsix", "four\nfive\nsix"]
    replies = [("a", 5, x) for x in lines] + [("b", 1, lines[0]), ("b", 1, lines[0]), ("c", 1, lines[1]), ("c", 2, None), (None, 1, "x\ny")]
    df = spark.createDataFrame(replies, "label string, completion_id long, reply string")
    for n in range(12):
        need = spark.createDataFrame([(c, n) for c in ("a", "b", "c", None)], "label string, need long")
        got = Counter(r.label for r in sv.ingest_completions(df, need).collect())
        assert got == Counter({c: min(n, most) for c, most in (("a", 9), ("b", 6), ("c", 3), (None, 2)) if n})
    again = {tuple(r) for r in sv.ingest_completions(df.repartition(4), need.withColumn("need", F.lit(4))).collect()}
    assert again == {tuple(r) for r in sv.ingest_completions(df, need.withColumn("need", F.lit(4))).collect()}


def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    df = spark.range(20).select("id", F.lit("x" * 1_000).alias("wide"))
    assert scale.local_copy(df).count() == 20
    monkeypatch.setattr(scale, "MAX_BROADCAST_BYTES", 10_000)
    assert scale.local_copy(df) is None and scale.checked_broadcast(df).count() == 20

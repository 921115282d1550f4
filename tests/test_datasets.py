"""Splits, samples, caps and joins: edge cases, and equality with the plain window form."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelloom.functions.draws import draw
from labelloom.operators import datasets as ds
from labelloom.operators import scale
from tests.conftest import plan, rows


def labelled(spark, **sizes):
    data, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            data.append((i, f"text {i}", None if label == "none" else label))
            i += 1
    return spark.createDataFrame(data, "record_id long, text string, label string")


def split_counts(df):
    return {(r["label"], r["split"]): r["count"] for r in df.groupBy("label", "split").count().collect()}


def test_split_sizes(spark):
    counts = split_counts(ds.stratified_split(labelled(spark, a=1, b=4, c=100, none=10)))
    assert counts == {
        ("a", "val"): 1, ("b", "val"): 1, ("b", "train"): 3, ("c", "val"): 20, ("c", "train"): 80,
        (None, "val"): 2, (None, "train"): 8,
    }


@pytest.mark.parametrize("edge_rows", [10, 1000, 1_000_000])
def test_split_equals_window_form(spark, monkeypatch, edge_rows):
    monkeypatch.setattr(scale, "EDGE_ROWS", edge_rows)
    # one label holds most of the rows
    df = spark.range(30_000).select(
        F.col("id").alias("record_id"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("label")
    )
    got = ds.stratified_split(df, 0.3, 7).filter("split = 'val'").select("record_id")
    order = Window.partitionBy("label").orderBy(draw(7, F.col("record_id"), "split"), "record_id")
    want = df.withColumn("rn", F.row_number().over(order)).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("label"))
    ).filter(F.col("rn") <= F.floor(F.col("n") * F.lit(0.3))).select("record_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_split_keeps_groups_together(spark):
    df = spark.range(400).select(
        F.col("id").alias("record_id"), F.lit("x").alias("label"), F.lit("t").alias("text"),
        (F.col("id") % 40).cast("string").alias("original_text"),
    )
    out = ds.stratified_split(df, 0.25, group_col="original_text")
    per_group = out.groupBy("original_text").agg(F.countDistinct("split").alias("sides"))
    assert per_group.filter("sides > 1").count() == 0
    assert out.filter("split = 'val'").count() == 100


def test_split_leaves_the_rows_where_they_are(spark):
    """The final pass over the table is a broadcast join and a projection."""
    out = ds.stratified_split(labelled(spark, a=50, b=50))
    assert "Exchange hashpartitioning" not in plan(out).split("== Physical Plan ==")[1]


def test_sample_quotas(spark):
    df = labelled(spark, a=2, b=20, c=20)
    got = {r["label"]: r["count"] for r in ds.stratified_sample(df, 10).groupBy("label").count().collect()}
    assert got == {"a": 2, "b": 3, "c": 3}
    quotas = {r["label"]: r["quota"] for r in ds.sample_quotas(df, 10).collect()}
    assert quotas == {"a": 4, "b": 3, "c": 3}


def test_cap_per_class(spark):
    df = spark.createDataFrame(
        [("a", i) for i in (900, 3, 50, 7)] + [("b", 1), ("c", 5)], "label string, line_no long"
    )
    need = spark.createDataFrame([("a", 2), ("b", 5), ("c", 0)], "label string, need long")
    assert rows(ds.cap_per_class(df, need)) == [("a", 3), ("a", 7), ("b", 1)]


def test_deficit(spark):
    df = labelled(spark, a=3, b=5, none=2)
    classes = ds.classes_table(spark, ["a", "b", "c"])
    got = ds.class_deficit(df, classes, 4).select("label", "have", "need")
    assert rows(got) == [("a", 3, 1), ("c", 0, 4)]


def test_pending_skips_duplicates_together(spark):
    samples = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "record_id long, text string")
    done = spark.createDataFrame([("x",), ("x",)], "original_text string")
    assert rows(ds.pending(samples, done).select("record_id")) == [(3,)]


def test_unknown_label(spark):
    df = labelled(spark, a=1, zz=1)
    classes = ds.classes_table(spark, ["a"])
    with pytest.raises(Exception, match="unknown label: zz"):
        ds.encode_labels(df, classes).collect()
    assert ds.encode_labels(df, classes, "drop").count() == 1
    assert rows(ds.quarantine_labels(df, classes).select("label")) == [("zz",)]


def test_missing_prediction(spark):
    df = labelled(spark, a=2)
    preds = spark.createDataFrame([(0, "a")], "record_id long, pred string")
    with pytest.raises(Exception, match="no prediction for record 1"):
        ds.attach_predictions(df, preds).collect()


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "label string, lang string, conv_type string, noised boolean")
    assert rows(ds.dataset_summary(empty)) == []


def test_shuffle_is_a_permutation(spark):
    df = labelled(spark, a=100)
    positions = [r["shuffle_pos"] for r in ds.with_shuffle_position(df, 3).collect()]
    assert sorted(positions) == list(range(100))
    by_position = [r["record_id"] for r in ds.with_shuffle_position(df, 3).orderBy("shuffle_pos").collect()]
    assert by_position == [r["record_id"] for r in ds.shuffle(df, 3).collect()]


def test_large_side_is_not_broadcast(spark):
    small, large = spark.range(10), spark.range(100)
    assert "rightHint" in plan(small.join(scale.checked_broadcast(small, 50), "id")) or "Broadcast" in plan(
        small.join(scale.checked_broadcast(small, 50), "id")
    )
    assert scale.checked_broadcast(large, 50) is large


def test_cutoffs_beyond_the_broadcast_limit(spark, monkeypatch):
    """More groups than may be broadcast: the same rows, by ordinary joins."""
    monkeypatch.setattr(scale.checked_broadcast, "__defaults__", (3,))
    df = labelled(spark, **{f"l{i}": i + 1 for i in range(9)})
    counts = split_counts(ds.stratified_split(df))
    assert sum(counts.values()) == 45
    assert all(counts[(f"l{i}", "val")] == max(1, int((i + 1) * 0.2)) for i in range(9))


def test_cutoffs_over_the_whole_bigint_range(spark):
    keys = [-(2**63), -5, 0, 1, 2, 7, 2**63 - 1]
    df = spark.createDataFrame([("g", k) for k in keys], "label string, at long")
    for k in range(1, 7):
        got = scale.cutoffs(df, ["label"], [F.col("at")], quota=lambda n: F.lit(k), edge_rows=1)
        assert got.first()["cut"]["o0"] == keys[k - 1]


def test_order_statistics_with_ties_and_outliers(spark):
    data = [("a", float(v)) for v in range(1000)] + [("b", 5.0)] * 500 + [("b", 1e12), ("c", 7.0), ("d", -3.5), ("d", 2.0)]
    df = spark.createDataFrame(data, "k string, v double")
    ranks = {"p50": lambda n: F.floor(n / 2), "p95": lambda n: F.floor(n * F.lit(0.95))}
    want = [("a", 1000, 500.0, 950.0), ("b", 501, 5.0, 5.0), ("c", 1, 7.0, 7.0), ("d", 2, 2.0, 2.0)]
    assert rows(scale.order_statistics(df, ["k"], "v", ranks)) == want
    assert rows(scale.order_statistics(df, ["k"], "v", ranks, edge_rows=1)) == want
    everything = sorted(v for _, v in data)
    row = scale.order_statistics(df, [], "v", ranks, edge_rows=1).first()
    assert tuple(row) == (len(data), everything[len(data) // 2], everything[int(len(data) * 0.95)])


@pytest.mark.parametrize("edge_rows", [1, 5, 1_000_000])
def test_cutoffs_with_crowded_buckets(spark, edge_rows):
    """Sort keys crowd together far from an outlier; the edge bucket is cut again."""
    keys = [10**15, *range(0, 3000, 3)]
    df = spark.createDataFrame([("g", k, k % 5) for k in keys] + [("h", 4, 2)], "label string, at long, w long")
    got = scale.cutoffs(df, ["label"], [F.col("at")], quota=lambda n: F.floor(n * F.lit(0.37)), edge_rows=edge_rows)
    assert {r["label"]: r["cut"]["o0"] if r["cut"] else None for r in got.collect()} == {
        "g": sorted(keys)[int(1001 * 0.37) - 1], "h": None,
    }
    quotas = spark.createDataFrame([("g", 777), ("h", 9)], "label string, quota long")
    got = scale.cutoffs(df, ["label"], [F.col("at")], quotas=quotas, weight=F.col("w"), edge_rows=edge_rows)
    total, at = 0, None
    for k in sorted(keys):
        if total + k % 5 >= 777:
            at, part = k, 777 - total
            break
        total += k % 5
    result = {r["label"]: r for r in got.collect()}
    assert (result["g"]["cut"]["o0"], result["g"]["part"], result["g"]["take_all"]) == (at, part, False)
    assert result["h"]["take_all"]


@pytest.mark.parametrize("edge_rows", [1_000_000, 3])
def test_exact_counts_with_ties(spark, edge_rows, monkeypatch):
    """Ties in every column and ties in the order only: exactly the quota is taken."""
    monkeypatch.setattr(scale, "EDGE_ROWS", edge_rows)
    data = [(7, "same", "a")] * 9 + [(7, f"t{i}", "a") for i in range(4)] + [(8, "x", "b"), (8, "x", "b"), (9, "y", "b")]
    df = spark.createDataFrame(data, "line_no long, text string, label string")
    need = spark.createDataFrame([("a", 5), ("b", 2)], "label string, need long")
    got = [(r.label, r.n) for r in ds.cap_per_class(df, need).groupBy("label").count().withColumnRenamed("count", "n").orderBy("label").collect()]
    assert got == [("a", 5), ("b", 2)]
    keyed = ds.with_record_id(df.select("text", "label"))
    split = ds.stratified_split(keyed, 0.2)
    assert split.count() == len(data)
    assert {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()} == {
        ("a", "val"): 2, ("a", "train"): 11, ("b", "val"): 1, ("b", "train"): 2,
    }
    assert ds.stratified_sample(keyed, 6).count() == 6


def test_many_groups_branch(spark, monkeypatch):
    """The branch for more groups than are looked at gives the same rows as the other."""
    df = spark.range(900).selectExpr("id AS record_id", "cast(id % 9 AS string) AS label", "'t' || id % 50 AS text")
    want = rows(ds.stratified_sample(df, 100))
    monkeypatch.setattr(scale.local_copy, "__defaults__", (3,))
    monkeypatch.setattr(scale.checked_broadcast, "__defaults__", (3,))
    monkeypatch.setattr(scale, "EDGE_ROWS", 5)
    assert rows(ds.stratified_sample(df, 100)) == want


def test_null_ids_are_an_error(spark):
    df = spark.createDataFrame([(None, "a", "x"), ("1", "a", "y")], "record_id string, label string, text string")
    with pytest.raises(Exception, match="record_id is NULL"):
        ds.stratified_split(df).collect()


def test_two_predictions_are_an_error(spark):
    df = spark.createDataFrame([("1", "a")], "record_id string, label string")
    preds = spark.createDataFrame([("1", "a"), ("1", "b")], "record_id string, pred string")
    with pytest.raises(Exception, match="several predictions"):
        ds.attach_predictions(df, preds).collect()

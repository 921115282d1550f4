"""Metrics, axes, gates and training history on small tables."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators import evaluate as ev
from tests.conftest import rows

SCHEMA = "record_id long, text string, label string, lang string, pred string"


def scored(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA)


def test_empty_class_scores_zero(spark):
    df = scored(spark, [("t", "a", "en", "a"), ("t", "a", "en", "b"), ("t", "b", "en", "b")])
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in ev.per_class_metrics(df, ["a", "b", "c"]).collect()}
    assert got["c"] == (0.0, 0.0, 0.0, 0)
    assert got["a"] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert got["b"] == (0.5, 1.0, pytest.approx(2 / 3), 1)


def test_cells_give_the_same_metrics(spark):
    df = scored(spark, [("t" * i, "ab"[i % 2], ["en", "mixed"][i % 3 == 0], "ab"[i % 5 == 0]) for i in range(60)])
    cells = ev.scored_cells(df)
    for plain, reduced in [
        (ev.per_class_metrics(df, ["a", "b"]), ev.per_class_metrics(cells, ["a", "b"], "n")),
        (ev.confusion_matrix(df, ["a", "b"]), ev.confusion_matrix(cells, ["a", "b"], "n")),
        (ev.crosslingual(df), ev.crosslingual(cells, weight="n")),
        (ev.codeswitch(df), ev.codeswitch(cells, weight="n")),
        (ev.length_buckets(df), ev.length_buckets(cells, weight="n")),
        (ev.accuracy(df), ev.accuracy(cells, "n")),
    ]:
        assert rows(plain) == rows(reduced)


def test_language_gap(spark):
    def with_accuracy(lang, right, total):
        return [("t", "a", lang, "a" if i < right else "b") for i in range(total)]

    exact = scored(spark, with_accuracy("en", 3, 4) + with_accuracy("ko", 2, 4))
    assert ev.crosslingual(exact, gap_pp=25.0).first()["flagged"] is False
    assert ev.crosslingual(exact, gap_pp=24.9).first()["flagged"] is True
    single = scored(spark, with_accuracy("en", 0, 4))
    assert ev.crosslingual(single).first()["flagged"] is False


def test_codeswitch_without_mixed_rows(spark):
    row = ev.codeswitch(scored(spark, [("t", "a", "en", "a")])).first()
    assert row["skipped"] and row["passed"] and row["mixed_acc"] is None


def test_empty_subset_is_null(spark):
    df = scored(spark, [("t", "a", "en", "a")])
    assert ev.subset_accuracy(df, F.col("lang") == "xx").first()["accuracy"] is None


def test_length_buckets(spark):
    texts = ["x" * 30, "x" * 31, "x" * 120, "가" * 121, "😀" * 30]
    got = {r["bucket"]: r["n"] for r in ev.length_buckets(scored(spark, [(t, "a", "en", "a") for t in texts])).collect()}
    assert got == {"short": 2, "medium": 2, "long": 1}
    empty = {r["bucket"]: (r["n"], r["accuracy"], r["passed"]) for r in ev.length_buckets(scored(spark, [("x", "a", "en", "a")])).collect()}
    assert empty["long"] == (0, None, True)


def test_hard_negatives(spark):
    signals = spark.createDataFrame(
        [("b", "a", "no file references"), ("b", "a", "ab"), ("b", "a", "Tool"), ("b", "a", "chain"), ("c", "a", "tool")],
        "label_b string, label_a string, signal string",
    )
    df = scored(
        spark,
        [("use a TOOL chain", "a", "en", "a"), ("no file references ab", "a", "en", "b"), ("tool", "b", "en", "b"), ("toolbox", "a", "en", "b")],
    )
    assert rows(ev.hard_negatives(df, signals).select("record_id", "label_a", "label_b")) == [
        (0, "a", "b"), (0, "a", "c"), (3, "a", "b"), (3, "a", "c"),
    ]
    assert rows(ev.hard_negative_accuracy(df, signals).select("label_b", "n", "accuracy", "passed")) == [
        ("b", 2, 0.5, False), ("c", 2, 0.5, False),
    ]


@pytest.mark.parametrize("values, p50, p95", [(range(1000), 500, 950), (range(200), 100, 190), ([7], 7, 7)])
def test_latency(spark, values, p50, p95):
    df = spark.createDataFrame([(float(v),) for v in values], "ms double")
    row = ev.latency_stats(df, []).first()
    assert (row["p50"], row["p95"]) == (p50, p95)
    assert row["passed"] == (p50 <= 50)


def test_latency_midpoint(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 9.0), ("b", 2.0)], "k string, ms double")
    got = {r["k"]: r["p50"] for r in ev.latency_stats(df, ["k"], median="midpoint").collect()}
    assert got == {"a": 1.5, "b": 2.0}


def history(spark, **runs):
    data = [(run, i + 1, v) for run, losses in runs.items() for i, v in enumerate(losses)]
    return spark.createDataFrame(data, "run_id string, epoch int, val_loss double")


@pytest.mark.parametrize("block_rows", [1, 2, 3, 1000])
def test_early_stopping(spark, block_rows):
    df = history(
        spark,
        stops=[1.0, 0.8, 0.9, 0.85, 0.8, 0.1],
        runs_on=[3.0, 2.0, 2.5, 1.0, 1.5],
        nan_first=[float("nan"), 2.0, 1.0],
        never=[float("nan")] * 4,
    )
    got = {r["run_id"]: tuple(r)[1:] for r in ev.early_stopping(df, block_rows=block_rows).collect()}
    assert got["stops"] == (2, 0.8, 5, 5, True)
    assert got["runs_on"] == (4, 1.0, 5, 5, False)
    assert got["nan_first"] == (3, 1.0, 3, 3, False)
    assert got["never"] == (None, None, 3, 3, True)


def test_log_loss(spark):
    df = spark.createDataFrame([([1000.0, 1000.0], 0), ([0.0, 2.0], 1)], "logits array<double>, label_idx int")
    row = ev.log_loss(df).first()
    assert row["loss"] == pytest.approx((0.6931471805599453 + 0.1269280110429725) / 2)
    assert row["accuracy"] == 1.0


def test_evaluate_and_release_gates(spark):
    df = scored(spark, [("t", c, "en", c) for c in "ab"] * 5)
    latency = spark.createDataFrame([(10.0,)], "ms double")
    verdicts = {r["axis"]: r["passed"] for r in ev.evaluate(df, ["a", "b"], latency=latency).collect()}
    assert verdicts == {
        "per_class_f1": True, "crosslingual": True, "codeswitch": True, "length_buckets": True, "latency": True, "overall": True,
    }
    verdicts = {r["axis"]: r["passed"] for r in ev.evaluate(df, ["a", "b", "unused"]).collect()}
    assert verdicts["per_class_f1"] is False and verdicts["overall"] is False
    gates = ev.release_gates(ev.per_class_metrics(df, ["a", "b"]), ev.latency_stats(latency, []), recall_class="zz")
    assert {r["gate"] for r in gates.collect()} == {"f1:a", "f1:b", "latency_p50", "overall"}


def test_unknown_labels_are_an_error(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "zz"), (None, "a")], "label string, pred string")
    for metric in (ev.confusion_matrix, ev.per_class_metrics):
        with pytest.raises(Exception, match="unknown label"):
            metric(df, ["a", "b"]).collect()
    assert ev.unknown_labels(df, ["a", "b"]).count() == 2
    assert ev.confusion_matrix(df, ["a", "b"], on_unknown="drop").agg({"n": "sum"}).first()[0] == 1


def test_rate_stats_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 10, 2.0), ("m", 20, 2.0)], "backend string, out_tokens int, elapsed_s double")
    assert rows(ev.rate_stats(df, ["backend"]).select("backend", "median_rate")) == [(None, 5.0), ("m", 10.0)]


def test_many_signals_stay_rows(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, "a", "alpha beta", "a"), (1, "a", "alpha beta", "a"), (2, "b", "gamma", "b")],
        "record_id int, label string, text string, pred string",
    )
    signals = spark.createDataFrame(
        [("a", "b", "alpha"), ("a", "b", "beta"), ("a", "c", "none"), ("b", "a", "GAMMA")],
        "label_a string, label_b string, signal string",
    )
    want = rows(ev.hard_negatives(df, signals).select("record_id", "label_a", "label_b"))
    monkeypatch.setattr(ev, "SIGNAL_ROWS", 1)
    assert rows(ev.hard_negatives(df, signals).select("record_id", "label_a", "label_b")) == want
    assert len(want) == 3

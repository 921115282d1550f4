"""Files, user functions, classifiers, streams and end-to-end flows."""

import json

import pytest
from pyspark.sql import functions as F

from labelloom.operators import classify as cf
from labelloom.operators import datasets as ds
from labelloom.operators import routing as rt
from labelloom.operators import supervise as sv
from labelloom.plans.flows import train_and_gate
from labelloom.sources import records as rec
from labelloom.streaming import streams
from tests.conftest import plan, rows


def test_strict_and_tolerant_reads(spark, tmp_path):
    good = '{"record_id": 1, "text": "가", "label": "a", "extra": 1}\n\n{"record_id": 2, "text": "b", "label": "a"}\n'
    (tmp_path / "good.jsonl").write_text(good, encoding="utf-8")
    (tmp_path / "bad.jsonl").write_text(good + '{"record_id": 3, "te\n{"text": "no label"}\n', encoding="utf-8")
    assert rec.read_records(spark, str(tmp_path / "good.jsonl")).count() == 2
    with pytest.raises(Exception):
        rec.read_records(spark, str(tmp_path / "bad.jsonl")).collect()
    assert rows(rec.read_records(spark, str(tmp_path / "bad.jsonl"), mode="tolerant")) == [(1, "가", "a"), (2, "b", "a")]


def test_write_keeps_characters(spark, tmp_path):
    df = spark.createDataFrame([(1, "한글 é", "a")], rec.RECORD)
    rec.write_records(df, str(tmp_path / "out"))
    lines = [p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert "한글 é" in lines[0] and json.loads(lines[0])["label"] == "a"
    assert rows(rec.read_records(spark, str(tmp_path / "out"))) == rows(df)


def test_naturalize_resumes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(i, f"text {i}", "ab"[i % 2]) for i in range(20)], rec.RECORD)

    def fn(text):
        return text.upper()

    options = {"n": 10, "seed": 1, "chunks": 3, "threads": 2}
    sv.naturalize(df, fn, path, **options)
    schema = rec.NATURALIZED
    first = rows(rec.read_records(spark, path, schema))
    assert len(first) == 10
    sv.naturalize(df, fn, path, done=rec.read_records(spark, path, schema), **options)
    assert rows(rec.read_records(spark, path, schema)) == first
    sv.naturalize(df, fn, path, done=rec.read_records(spark, path, schema), **{**options, "n": 20})
    assert rec.read_records(spark, path, schema).select("original_text").distinct().count() == 20


def test_rephrase_keeps_every_row(spark):
    class RateLimitError(Exception):
        pass

    calls = {"n": 0}

    def fn(text):
        if text == "limited once":
            calls["n"] += 1
            if calls["n"] == 1:
                raise RateLimitError()
            return "after retry"
        if text == "always limited":
            raise RateLimitError()
        if text == "error":
            raise ValueError("x")
        return "" if text == "empty" else f" {text}! "

    texts = ["fine", "limited once", "always limited", "error", "empty"]
    df = spark.createDataFrame([(i, t, {"k": "v"}) for i, t in enumerate(texts)], "record_id long, text string, other map<string,string>")
    got = {r["original_text"]: (r["text"], r["error"], r["other"]) for r in sv.rephrase(df, fn, wait_s=0.0, threads=1).collect()}
    kept = {"k": "v"}
    assert got == {
        "fine": ("fine!", None, kept), "limited once": ("after retry", None, kept),
        "always limited": ("always limited", "rate limit", kept), "error": ("error", "ValueError: x", kept),
        "empty": ("empty", "empty reply", kept),
    }


def test_completion_errors_do_not_stop_others(spark):
    def fn(prompt):
        if "2" in prompt:
            raise RuntimeError("down")
        return prompt + "!"

    df = spark.createDataFrame([(f"p{i}",) for i in range(4)], "prompt string")
    got = {r["prompt"]: (r["reply"], r["error"]) for r in sv.complete(df, fn, partitions=2).collect()}
    assert got["p2"] == (None, "RuntimeError: down") and got["p3"] == ("p3!", None)


CLASSES = ["bird", "fish"]


def toy(spark, n=60):
    data = [(i, f"{'feather wing' if i % 2 else 'gill scale'} number {i}", CLASSES[1 - i % 2]) for i in range(n)]
    return spark.createDataFrame(data, rec.RECORD)


@pytest.fixture(scope="module")
def bayes(spark):
    return cf.train_naive_bayes(toy(spark), CLASSES, buckets=1024)


def test_naive_bayes(spark, bayes):
    out = bayes.predict(toy(spark, 20))
    assert out.filter("pred = label").count() == 20
    shown = plan(out).split("== Physical Plan ==")[1]
    assert "Join" not in shown.split("Subquery")[0] and "Exchange" not in shown.split("Subquery")[0]
    assert "__w" not in shown  # the weights stay out of the rows
    empty = spark.createDataFrame([(1, "")], "record_id long, text string")
    assert bayes.predict(empty).first()["pred"] == "bird"


def test_logistic_keeps_the_best_candidate(spark):
    split = ds.stratified_split(toy(spark, 80))
    train, val = split.filter("split = 'train'"), split.filter("split = 'val'")
    model = cf.train_logistic(train, val, ds.classes_table(spark, CLASSES), (10.0, 0.01), 10, num_features=1 << 12)
    losses = [loss for _, loss, _ in model.history]
    assert losses[1] < losses[0]
    assert model.predict(val).filter("pred = label").count() == val.count()


def test_logistic_reads_each_text_once_and_makes_the_vectors_of_hashing_tf(spark):
    split = ds.stratified_split(toy(spark, 40)).checkpoint()
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = split.mapInArrow(count, split.schema)
    train, val = counted.filter("split = 'train'"), counted.filter("split = 'val'")
    classes = ds.classes_table(spark, CLASSES)
    cf.train_logistic(train, val, classes, (10.0, 0.01), 3, num_features=1 << 8)
    assert read.value == 2 * split.count()  # once for each of the two tables, whatever the number of models
    rows = ds.encode_labels(split, classes).unionByName(ds.encode_labels(split, classes).limit(1).withColumn("text", F.lit("")))
    made = cf.written_vectors(rows, [2, 3], 1 << 8).collect()
    want = cf._vectors(rows, [2, 3], 1 << 8).select("label_idx", "features").collect()
    assert sorted(map(str, made)) == sorted(map(str, want))


def test_predict_batches_limits_the_batch(spark):
    def fn(texts):
        assert len(texts) <= 7
        return [str(len(texts))] * len(texts)

    out = cf.predict_batches(toy(spark, 30).coalesce(1), fn, batch=7)
    assert sorted(r["pred"] for r in out.collect()) == ["2"] * 2 + ["7"] * 28


def test_classify_stream_equals_batch(spark, bayes, tmp_path):
    lines = toy(spark, 20).select("record_id", F.when(F.col("record_id") == 3, "  ").otherwise(F.col("text")).alias("text"))
    lines.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(lines.schema).parquet(str(tmp_path / "in"))

    def predict(df):
        return bayes.predict(df).select("record_id", "pred")

    streams.classify_lines(
        stream, predict, str(tmp_path / "out"), str(tmp_path / "cp"), fmt="parquet", once=True
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got) == rows(predict(ds.non_blank(lines))) and got.count() == 19


STEPS = [rt.prefix([("/code", "code")]), rt.question(), rt.length([{"max": 5, "label": "short"}]), rt.always()]


@pytest.fixture()
def request_files(spark, tmp_path):
    texts = ["/code x", "is it", "tiny", "something longer", None]
    data = [
        {"request_id": i, "ts": "2024-01-01T00:00:10Z", "text": t, "context": {"user_id": str(i)}} for i, t in enumerate(texts) if t
    ]
    (tmp_path / "requests").mkdir()
    for i in range(2):
        body = "".join(json.dumps(r) + "\n" for r in data[i::2])
        (tmp_path / "requests" / f"{i}.json").write_text(body)
    return str(tmp_path / "requests")


def test_route_stream_equals_batch(spark, request_files, tmp_path):
    batch = rt.route(rec.read_requests(spark, request_files), STEPS)
    query = streams.route_stream(
        rec.read_requests(spark, request_files, stream=True), STEPS, str(tmp_path / "out"), str(tmp_path / "cp"), once=True
    )
    query.awaitTermination()
    got = spark.read.schema(batch.schema).json(str(tmp_path / "out"))
    keep = ["request_id", "label", "method", "text"]
    assert rows(got.select(*keep)) == rows(batch.select(*keep)) and got.count() == 4
    rec.write_decisions(batch, str(tmp_path / "batch"))
    assert spark.read.schema(batch.schema).json(str(tmp_path / "batch")).first()["context"]["user_id"]


def test_route_stream_reads_health_anew(spark, request_files, tmp_path):
    routes = spark.createDataFrame(
        [("code", ["x", "y"]), ("chat", ["y"]), ("short", ["x"]), ("default", ["z"])], "label string, backends array<string>"
    )
    table = str(tmp_path / "health")
    spark.sql("select 'x' backend, timestamp'2024-01-01 00:00:00' checked_at, false up").write.parquet(table)
    query = streams.route_stream_with_health(
        rec.read_requests(spark, request_files, stream=True), STEPS, routes, lambda s: s.read.parquet(table),
        str(tmp_path / "out"), str(tmp_path / "cp"), now=lambda: F.lit("2024-01-01 00:00:30").cast("timestamp"), once=True,
    )
    query.awaitTermination()
    got = {r["label"]: (r["backend"], r["fallback_used"], r["error"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {
        "code": ("y", True, None), "chat": ("y", False, None),
        "short": (None, False, "no_backends_available"), "default": ("z", False, None),
    }


def test_train_and_gate(spark):
    latency = spark.createDataFrame([(3.0,)], "ms double").withColumn("passed", F.lit(True))
    _, gates = train_and_gate([toy(spark, 40), toy(spark, 20)], toy(spark, 20), latency, CLASSES, buckets=1024)
    assert all(r["passed"] for r in gates.collect())

"""Generation and evaluation flows, and the ledger of calls."""

import json
import os

import pytest
from pyspark.sql import functions as F

from labelloom.operators import supervise as sv
from labelloom.plans import flows
from labelloom.sources.ledger import Ledger

CLASSES = [("cat", "about cats"), ("dog", None), ("owl", "about owls")]


def classes_table(spark):
    return spark.createDataFrame(CLASSES, "label string, description string")


def logged(folder, reply):
    """A function that leaves a file for each call; calls count over all workers and runs."""
    import uuid

    def fn(prompt):
        label = next(c for c in ("cat", "dog", "owl") if f'label "{c}"' in prompt)
        with open(f"{folder}/{label}-{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        return reply(label, prompt)

    return fn


def calls(folder):
    return sorted(name.split("-")[0] for name in os.listdir(folder))


def test_generate_fills_the_classes_and_goes_on(spark, tmp_path):
    path, log = str(tmp_path / "data"), str(tmp_path / "log")
    os.mkdir(log)
    os.mkdir(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write("\n".join([json.dumps({"text": f"cat {i}", "label": "cat"}) for i in range(5)] + ["{broken", json.dumps({"text": "d", "label": "dog"})]))

    def reply(label, prompt):
        if label == "owl":
            raise RuntimeError("no owls today")
        return "\n".join(f"{k + 1}. {label} line {k}" for k in range(9)) + "\n\n"

    done = flows.generate(classes_table(spark), path, 5, "animals", logged(log, reply))
    assert sorted(tuple(r)[1:] for r in done.collect()) == [("dog", 1, 4, 4, None), ("owl", 0, 5, 0, "RuntimeError: no owls today")]
    assert calls(log) == ["dog", "owl"]  # cat is full
    texts = flows.generated(spark, path).filter("label = 'dog'").collect()
    assert sorted(r.text for r in texts) == ["d", *[f"dog line {k}" for k in range(4)]]

    again = flows.generate(classes_table(spark), path, 5, "animals", logged(log, lambda label, _: f"- a {label}\n- the {label}"), rounds=3)
    assert sorted(tuple(r) for r in again.collect()) == [
        (0, "owl", 0, 5, 2, None), (1, "owl", 2, 3, 2, None), (2, "owl", 4, 1, 1, None)]
    assert flows.generated(spark, path).groupBy("label").count().filter("count = 5").count() == 3
    assert flows.generate(classes_table(spark), path, 5, "animals", logged(log, reply)).collect() == []
    assert calls(log) == ["dog"] + ["owl"] * 4


def test_a_killed_run_asks_at_most_once(spark, tmp_path):
    """The task dies after five calls; tasks that are tried again and the next run read the ledger."""
    log = tmp_path / "log"
    log.mkdir()
    folder, fail = str(log), str(tmp_path / "fail")
    open(fail, "w").close()

    def fn(prompt):
        import os
        import signal
        import uuid

        if os.path.exists(fail) and len(os.listdir(folder)) >= 5:
            os.kill(os.getpid(), signal.SIGKILL)
        with open(f"{folder}/{prompt}-{uuid.uuid4().hex}", "w"):
            pass
        return f"reply to {prompt}"

    ledger = Ledger(str(tmp_path / "ledger"))
    prompts = spark.createDataFrame([(f"p{i}",) for i in range(20)], "prompt string").coalesce(1)
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone
        sv.complete(prompts, fn, ledger=ledger).collect()
    assert len(calls(folder)) == 5
    os.rename(fail, fail + ".over")
    got = sv.complete(prompts, fn, ledger=ledger).collect()
    assert {r.prompt: r.reply for r in got} == {f"p{i}": f"reply to p{i}" for i in range(20)}
    assert calls(folder) == sorted(f"p{i}" for i in range(20))  # once each
    texts = prompts.select(F.col("prompt").alias("text"))
    assert {r.text for r in sv.rephrase(texts, fn, ledger=ledger).collect()} == {f"reply to p{i}" for i in range(20)}
    assert len(calls(folder)) == 20


def test_ledger_keeps_replies_apart(tmp_path):
    a, b = Ledger(str(tmp_path)), Ledger(f"file://{tmp_path}", "other")
    assert a.get("x") is None
    a.put("x", "é\n")
    assert a.get("x") == "é\n" and b.get("x") is None and a.get("") is None
    a.put("x", "later")
    assert a.get("x") == "later"
    tried = []
    ask = b.through(lambda q: tried.append(q))
    assert ask("q") is None and ask("q") is None and tried == ["q", "q"]  # nothing is committed


def test_split_and_evaluate(spark):
    rows = [(i, f"{'feather wing' if i % 2 else 'gill scale'} number {i}", "bird" if i % 2 else "fish", "en" if i % 3 else "ko") for i in range(120)]
    df = spark.createDataFrame(rows, "record_id long, text string, label string, lang string")
    latency = spark.createDataFrame([(12.0,), (30.0,)], "ms double")
    scored, verdicts, report = flows.split_and_evaluate(df, ["bird", "fish"], latency=latency, buckets=1024)
    assert 20 <= scored.count() <= 28 and {"pred", "label", "lang", "record_id"} <= set(scored.columns)
    passed = {r.axis: r.passed for r in verdicts.collect()}
    assert passed["overall"] and passed["latency"]
    figures = {(r.axis, r.key): r for r in report.collect()}
    assert figures["per_class_f1", "bird"].value == 1.0 and figures["latency", "all"].bound == 50.0
    for axis in {a for a, _ in figures}:
        assert passed[axis] == all(r.passed for (a, _), r in figures.items() if a == axis)

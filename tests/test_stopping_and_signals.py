"""Early stopping from block summaries and hard negatives by automata, against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import evaluate as ev
from labelloom.operators import stopping

from tests.conftest import plan, rows


def plain_stop(history, patience):
    """(best epoch, best loss, last epoch, epochs, stopped) of (epoch, loss) in order."""
    best, best_epoch, since = math.inf, None, 0
    for n, (epoch, loss) in enumerate(history, 1):
        if loss is not None and loss < best:
            best, best_epoch, since = loss, epoch, 0
        else:
            since += 1
        if since >= patience:
            return best_epoch, None if best_epoch is None else best, epoch, n, True
    return best_epoch, None if best_epoch is None else best, history[-1][0], len(history), False


def histories(seed, n=60):
    rng = random.Random(seed)
    for _ in range(n):
        size, epoch, out = rng.randrange(1, 60), rng.randrange(5), []
        for k in range(size):
            epoch += rng.choice([1, 1, 1, 2, 9])
            loss = rng.choice([rng.randrange(10) / 8, 5 - k / 20, None, math.nan, math.inf]) if rng.random() < 0.5 else 4 - k / 30
            out.append((epoch, loss))
        yield out


@pytest.mark.parametrize("patience", [1, 2, 3, 7])
def test_summaries_combine_to_the_same_end(patience):
    for history in histories(patience, 400):
        want = plain_stop(history, patience)
        for size in (1, 2, 5, 16, 1000):
            parts = {}
            for epoch, loss in history:
                parts.setdefault(epoch // size, []).append((epoch, math.nan if loss is None else loss))
            made = [
                stopping.summary(stopping.np.array([e for e, _ in p]), stopping.np.array([x for _, x in p], float), patience)
                for _, p in sorted(parts.items())
            ]
            assert all(len(m[1]) <= patience and len(m[2]) <= patience for m in made)  # of fixed size
            assert stopping.combined(iter(made), patience) == want


def test_early_stopping_reads_once(spark):
    data = [(f"r{k}" if k else None, e, x) for k, h in enumerate(histories(3, 40)) for e, x in h]
    df = spark.createDataFrame(data, "run_id string, epoch int, val_loss double").repartition(5)
    out = ev.early_stopping(df, 3, block_rows=8)
    got = {r.run_id: tuple(r)[1:] for r in out.collect()}
    assert got == {f"r{k}" if k else None: plain_stop(h, 3) for k, h in enumerate(histories(3, 40))}
    shown = plan(out).split("== Physical Plan ==")[1].split("Initial Plan")[-1]
    assert shown.count("Exchange hashpartitioning") <= 3 and shown.count("MapInArrow") == 2
    assert out.schema["best_epoch"].dataType.simpleString() == "int"
    assert ev.early_stopping(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ev.early_stopping(df, 0)


def signal_tables(spark, seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé ", k=rng.randrange(2, 9))) for _ in range(n)]
    signals = [(rng.choice("ABC"), rng.choice("ABC"), rng.choice(["", "no "]) * (rng.random() < 0.1) + w.upper()) for w in words]
    texts = [(i % 150, rng.choice("ABCD"), "".join(rng.choices("abcdEÉ ", k=rng.randrange(80)))) for i in range(200)]
    texts += [(1, "A", None), (2, "A", ""), (3, None, "abc"), texts[0], texts[0]]
    df = spark.createDataFrame(texts, "record_id int, label string, text string").withColumn("pred", F.lit("A")).repartition(3)
    return df, spark.createDataFrame(signals, "label_a string, label_b string, signal string"), texts, signals


@pytest.mark.parametrize("size", [2_000_000, 700])
def test_automata_find_what_the_arrays_find(spark, monkeypatch, size):
    df, signals, texts, given = signal_tables(spark, size, 300)
    want = rows(ev.hard_negatives(df, signals))
    monkeypatch.setattr(ev, "AUTOMATON_BYTES", size)
    found = ev.hard_negatives(df, signals, signal_rows=0)
    assert rows(found) == want and found.columns == [*df.columns, "label_a", "label_b"]
    plain = sorted(
        (i, a, b)
        for i, a, text in texts
        for b in {b for x, b, s in given if x == a and a != b and len(s) >= 3 and not s.startswith("no ") and s.lower() in (text or "").lower()}
    )
    assert sorted((r.record_id, r.label_a, r.label_b) for r in found.collect()) == plain
    assert rows(ev.hard_negative_accuracy(df, signals)) == rows(
        found.groupBy("label_a", "label_b").agg(F.count("*").alias("n"), F.sum((F.col("pred") == F.col("label")).cast("long")).alias("correct"))
        .withColumn("accuracy", F.col("correct") / F.col("n")).withColumn("passed", F.col("accuracy") >= 0.75))


def test_many_signals_of_few_classes(spark, monkeypatch):
    """200,000 signals in three classes: several automata, no join on the label."""
    signals = spark.range(200_000).select(
        F.element_at(F.array(*map(F.lit, "ABC")), (F.col("id") % 3 + 1).cast("int")).alias("label_a"),
        F.element_at(F.array(*map(F.lit, "ABC")), ((F.col("id") + 1 + F.col("id") % 2) % 3 + 1).cast("int")).alias("label_b"),
        F.concat(F.lit("Signal "), "id", F.lit(";")).alias("signal"),
    )
    texts = [(i, "ABC"[i % 3], f"x signal {i}; signal {i + 3}; signal 999999; y") for i in range(600)]
    df = spark.createDataFrame(texts, "record_id int, label string, text string")
    monkeypatch.setattr(ev, "AUTOMATON_BYTES", 1_500_000)
    got = sorted((r.record_id, r.label_b) for r in ev.hard_negatives(df, signals).collect())
    against = [(i, "ABC"[(k + 1 + k % 2) % 3]) for i, _, _ in texts for k in (i, i + 3)]
    assert got == sorted(set((i, b) for i, b in against if b != "ABC"[i % 3]))


def test_no_signals_and_no_rows(spark):
    df, signals, _, _ = signal_tables(spark, 1, 20)
    assert ev.hard_negatives(df, signals.limit(0), signal_rows=-1).collect() == []
    assert ev.hard_negatives(df.limit(0), signals, signal_rows=0).collect() == []

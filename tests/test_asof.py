"""Health as of each request's time: by row in batches, and in streams however they are cut."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from labelloom.operators import health as hl
from labelloom.streaming import streams

START = datetime(2026, 1, 1)
ROUTES = [("code", ["x", "y", "z"]), ("chat", ["z", "x"]), ("solo", ["y"]), ("none", [])]


def at(second):
    return None if second is None else START + timedelta(seconds=second)


def routes_table(spark):
    return spark.createDataFrame(ROUTES, "label string, backends array<string>")


def checks_table(spark, checks):
    return spark.createDataFrame([(b, at(s), up) for b, s, up in checks], "backend string, checked_at timestamp, up boolean")


def decisions_table(spark, rows):
    return spark.createDataFrame([(i, at(s), label, e) for i, s, label, e in rows], "request_id long, ts timestamp, label string, error string")


def brute(rows, checks, ttl=60, unknown="up"):
    chains, out = dict(ROUTES), []
    for i, second, label, error in rows:
        backend, pos = None, None
        for p, name in enumerate(chains.get(label, [])):
            fit = [(s, up) for b, s, up in checks if second is not None and b == name and second - ttl <= s <= second]
            states = [up for s, up in fit if s == max(fit)[0] and up is not None] if fit else []
            if (any(states) if states else unknown == "up"):
                backend, pos = name, p
                break
        why = error or ("unknown_route" if label not in chains else "no_backends_available" if backend is None else None)
        out.append((i, at(second), label, why, backend, bool(pos)))
    return Counter(out)


def world(seed, span=600):
    rng = random.Random(seed)
    checks = [(rng.choice("xyzq"), rng.randrange(span * 4) / 4, rng.random() < 0.4) for _ in range(span // 4)]
    checks += [("x", 100, True), ("x", 100, False), ("y", 60, False), ("y", 120, False)]  # two at one instant, and block borders
    rows = [
        (rng.choice([None, 1, 2, i]), rng.randrange(span * 4) / 4, rng.choice(["code", "code", "chat", "solo", "none", "nowhere", None]), None)
        for i in range(250)
    ]
    rows += [(5, 120, "solo", None), (5, 120.25, "solo", None), (5, 180, "solo", None), (7, 100, "code", None), (8, 10, None, "pipeline_exhausted")]
    return rows, checks


@pytest.mark.parametrize("rows_per_task, unknown", [(3, "up"), (1_000_000, "down")])
def test_asof_by_row(spark, rows_per_task, unknown):
    rows, checks = world(1)
    rows += [(1, None, "code", None), *rows[:20]]  # no time, and repeated rows
    out = hl.resolve_backends_asof(
        decisions_table(spark, rows).repartition(3), routes_table(spark), checks_table(spark, checks), 60, unknown, rows_per_task
    )
    assert out.columns == ["request_id", "ts", "label", "error", "backend", "fallback_used"]
    assert Counter(map(tuple, out.collect())) == brute(rows, checks, 60, unknown)


def test_asof_with_repeated_and_null_ids(spark):
    checks = [("x", 29, False), ("y", 29, True)]
    rows = [(2, 0, "code", None), (2, 30, "code", None), (None, 0, "code", None), (None, 30, "code", None)]
    got = hl.resolve_backends_asof(decisions_table(spark, rows), routes_table(spark), checks_table(spark, checks))
    assert Counter((r.request_id, r.ts, r.backend, r.fallback_used) for r in got.collect()) == Counter(
        [(2, at(0), "x", False), (2, at(30), "y", True), (None, at(0), "x", False), (None, at(30), "y", True)]
    )


def test_asof_runs_its_input_once(spark):
    asked = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    rows, checks = world(2)
    counted = decisions_table(spark, rows).mapInArrow(count, "request_id long, ts timestamp, label string, error string")
    hl.resolve_backends_asof(counted, routes_table(spark), checks_table(spark, checks)).collect()
    assert asked.value == len(rows)


def test_asof_of_empty_tables(spark):
    rows, checks = world(3)
    assert hl.resolve_backends_asof(decisions_table(spark, []), routes_table(spark), checks_table(spark, checks)).collect() == []
    got = hl.resolve_backends_asof(decisions_table(spark, rows), routes_table(spark), checks_table(spark, []))
    assert Counter(map(tuple, got.collect())) == brute(rows, [])
    none = routes_table(spark).filter("false")
    assert {r.error for r in hl.resolve_backends_asof(decisions_table(spark, rows), none, checks_table(spark, checks)).collect()} == {
        "unknown_route", "pipeline_exhausted"}


def stream_of(spark, df, time, cuts, folder):
    """A stream that gives the rows up to each cut as a file of its own."""
    last = None
    for n, cut in enumerate(cuts):
        own = df.filter(F.lit(True) if cut is None else F.col(time) <= F.lit(at(cut)))
        own = own if last is None else own.filter(F.col(time) > F.lit(at(last)))
        own.coalesce(1).write.mode("append").parquet(folder)
        last = cut
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("cuts, salts", [([150, 151, 400, None], 1), ([600, None], 3)])
def test_stream_equals_batch(spark, tmp_path, cuts, salts):
    rows, checks = world(4, span=300 if salts > 1 else 500)
    last = [("z", 5_000, True)]  # moves the watermark past all requests
    decisions = stream_of(spark, decisions_table(spark, rows), "ts", cuts, str(tmp_path / "asked"))
    health = stream_of(spark, checks_table(spark, checks + last), "checked_at", cuts, str(tmp_path / "checks"))
    found = streams.resolve_stream_asof(decisions, health, routes_table(spark), delay_s=700, salts=salts)
    streams._sink(found, str(tmp_path / "out"), str(tmp_path / "cp"), "parquet", True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(tuple, got.select("request_id", "ts", "label", "error", "backend", "fallback_used").collect())) == brute(rows, checks)


def test_state_is_bounded_by_the_ttl():
    """The processor alone: checks older than one TTL before the watermark go, requests go when they are resolved."""
    from labelloom.streaming.asof import AsofRoutes, Row

    class State(list):
        appendList = list.extend

        def get(self):
            return iter(list(self))

        def put(self, rows):
            self[:] = rows

    class Handle:
        def __init__(self):
            self.timers = []

        def getListState(self, name, schema):
            return State()

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    handle, router = Handle(), AsofRoutes(60_000_000, "up")
    router.init(handle)
    most, out = 0, []
    for second in range(0, 3_600, 5):
        rows = [Row(at=(second + k) * 1_000_000, size=0, pos=0, up=k % 2 == 0, payload=None) for k in range(5)]
        rows.append(Row(at=second * 1_000_000, size=1, pos=None, up=None, payload=str(second)))
        out += router.handleInputRows(None, iter(rows), Now(0))
        for timer in sorted(t for t in handle.timers if t <= second * 1000):
            handle.timers.remove(timer)
            out += router.handleExpiredTimer(None, Now(second * 1000), None)
        most = max(most, len(router.checks) + len(router.waiting))
    assert most <= 60 + 10 and len(out) == 720


def test_stream_needs_its_state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            streams.resolve_stream_asof(decisions_table(spark, []), checks_table(spark, []), routes_table(spark))
    finally:
        spark.conf.set(name, given)


def test_crowded_blocks_are_cut_by_time_without_copies_of_checks(spark, monkeypatch):
    """The checks of a block meet every request once, whatever the number of both; only one instant is salted."""
    copies, salted = [], hl.hot_salts

    def counting(df, keys, rows_per_task):
        out = salted(df, keys, rows_per_task)
        copies.append(out.agg(F.sum("__salts")).first()[0] or 0)
        return out

    monkeypatch.setattr(hl, "hot_salts", counting)
    checks = [("x", k / 8 + 0.0625, k % 3 == 0) for k in range(900)] + [("z", 3, False)]
    rows = [(k, k / 16, "chat", None) for k in range(1900)] + [(k, 5.5, "chat", None) for k in range(40)]
    asked = decisions_table(spark, rows).withColumn("backend", F.lit("x"))
    seen = {(r.request_id, r.ts): (r.checked_at, r.up) for r in hl.health_asof(asked, checks_table(spark, checks), 60, rows_per_task=2).collect()}
    for i, second, _, _ in rows:
        last = max(((s, up) for b, s, up in checks if b == "x" and second - 60 <= s <= second), default=(None, True))
        assert seen[i, at(second)] == (at(last[0]), last[1])
    out = hl.resolve_backends_asof(decisions_table(spark, rows), routes_table(spark), checks_table(spark, checks), 60, "up", 2)
    assert Counter(map(tuple, out.collect())) == brute(rows, checks)
    assert len(copies) == 2 and max(copies) < 50


def test_keys_of_the_stream_are_blocks_of_time(spark):
    """A check is in two keys of a route at most, with every request that it is fresh for, and no key has more than a few TTLs."""
    checks = [(b, k * 7.25, k % 2 == 0) for k in range(400) for b in "xz"] + [("x", None, True)]
    rows = [(k, k * 3.0, "chat", None) for k in range(1000)] + [(0, None, "chat", None)]
    keyed, _ = streams.asof_rows(decisions_table(spark, rows), checks_table(spark, checks), routes_table(spark), 60, 1)
    got = [r for r in keyed.collect() if r["__route"] == "chat"]
    copies = Counter((r.at, r.pos) for r in got if not r.asked)
    assert max(copies.values()) == 2 and sum(copies.values()) < 800 * 1.3
    keys = {}
    for r in got:
        keys.setdefault((r["__block"], r["__salt"]), []).append(r)
    assert len(keys) > 10
    for members in keys.values():
        times = [r.at for r in members if r["__ts"] is not None]
        assert not times or max(times) - min(times) <= (streams.BLOCK_TTLS + 1) * 60_000_000
    seen = {(r.at, c.at, c.pos) for members in keys.values() for r in members if r.asked for c in members if not c.asked}
    start = min(r.at for r in got if r.asked and r["__ts"] is not None)
    for _, second, _, _ in rows[:-1]:
        for b, when, _ in checks[:-1]:
            if when <= second <= when + 60:
                assert (start + int(second * 1e6), start + int(when * 1e6), "zx".index(b)) in seen


def test_state_of_blocks_is_bounded_by_the_ttl():
    """Frames in, frames out: the checks that can still be fresh and the requests that wait, in few entries."""
    import numpy as np
    import pandas as pd

    from labelloom.streaming.asof import NO_TIME, AsofBlocks

    class State(list):
        appendValue = list.append
        get = list.copy

    class Handle:
        def __init__(self):
            self.timers = []

        def getListState(self, name, schema):
            return State()

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    handle, router = Handle(), AsofBlocks(60_000_000, "up")
    router.init(handle)
    most, out, names = 0, [], ["asked", "at", "size", "pos", "up", "payload"]
    for second in range(0, 3_600, 5):
        rows = [(False, (second + k) * 1_000_000, 0, 0, k % 2, None) for k in range(4)]
        rows += [(True, second * 1_000_000, 1, -1, -1, str(second)), (True, NO_TIME, 1, -1, -1, "timeless")]
        frames = [pd.DataFrame(rows[:3], columns=names), pd.DataFrame(rows[3:], columns=names)]
        out += router.handleInputRows(None, iter(frames), Now(0))
        for timer in sorted(t for t in handle.timers if t <= second * 1000):
            handle.timers.remove(timer)
            out += router.handleExpiredTimer(None, Now(second * 1000), None)
        most = max(most, sum(len(e[0]) // 8 for e in router.checks) + sum(len(e[0]) // 8 for e in router.waiting))
    got = pd.concat(out)
    assert most <= 60 + 10 and len(got) == 1440 and set(got[got.payload == "timeless"].pos) == {0}
    assert list(got[got.payload != "timeless"].pos.unique()) == [-1]  # the check of each request's second says down
    assert got.pos.dtype == np.int32

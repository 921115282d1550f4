"""Routing steps, decisions, fallback chains and health."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from labelloom.operators import health as hl
from labelloom.operators import routing as rt
from tests.conftest import plan, rows


def decide(spark, texts, steps):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "request_id long, text string")
    return [(r["label"], r["method"]) for r in rt.route(df, steps).orderBy("request_id").collect()]


def labels(spark, texts, step):
    return [label for label, _ in decide(spark, texts, [step])]


def test_prefix(spark):
    df = spark.createDataFrame([("/code  fix it",), ("/codex",), ("say /code",)], "text string")
    step = rt.prefix([("/code", "code"), ("/c", "other")])
    got = [(r["label"], r["text"]) for r in rt.route(df, [step]).collect()]
    assert got == [("code", "fix it"), ("code", "x"), (None, "say /code")]
    kept = rt.route(df, [rt.prefix([("/code", "code")], strip_prefix=False)]).first()
    assert kept["text"] == "/code  fix it"


def test_code_block(spark):
    texts = ["```\nx\n```", "open ``` only", "``````", "a\n    b\n    c", "a\n    b\n\n    c", "    b\n    c"]
    assert labels(spark, texts, rt.code_block()) == ["code", None, "code", "code", None, "code"]


def test_question(spark):
    texts = ["island life", "Is it on", "tell me?", "tell me? \n", "whatever", "how", "so what"]
    assert labels(spark, texts, rt.question()) == [None, "chat", "chat", "chat", None, "chat", None]


def test_regex_order_and_flags(spark):
    step = rt.regex([("(?i)^(fix|debug)", "code"), ("bug", "triage")])
    assert labels(spark, ["FIX the bug", "a bug", "a BUG"], step) == ["code", "triage", None]


def test_spec_example(spark):
    steps = [rt.regex([(r"(?i)^(fix|debug|error|traceback|exception)", "code")]), rt.always()]
    df = spark.createDataFrame([("fix the bug in this code",)], "text string")
    row = rt.route(df, steps).first()
    assert (row["label"], row["method"], row["confidence"]) == ("code", "regex", 1.0)


def test_keyword_edges(spark):
    step = rt.keyword([(["fix", "clean up", "def ", "français", "c++"], "hit")])
    texts = ["prefix", "FIX!", "please clean up", "def x", "undef x", "en FRANÇAIS.", "PR을 fix해줘", "c++17", "c++", "a_fix"]
    assert labels(spark, texts, step) == [None, "hit", "hit", "hit", None, "hit", None, "hit", "hit", None]


def test_keyword_modes(spark):
    rules = [(["aa", "bb"], "hit")]
    texts = ["aa bb", "aa", "xaabb", "AA BB"]
    assert labels(spark, texts, rt.keyword(rules, match="all")) == ["hit", None, None, "hit"]
    assert labels(spark, texts, rt.keyword(rules, match_mode="substring", match="all")) == ["hit", None, "hit", "hit"]
    assert labels(spark, texts, rt.keyword(rules, case_sensitive=True)) == ["hit", "hit", None, None]
    with pytest.raises(ValueError):
        rt.keyword(rules, match="some")


def test_bad_steps_fail_when_built(spark):
    for make in (
        lambda: rt.prefix([]),
        lambda: rt.regex([]),
        lambda: rt.keyword([([], "x")]),
        lambda: rt.length([{"label": "x"}]),
        lambda: rt.length([{"max": 1, "label": "x"}], unit="lines"),
        lambda: rt.route(spark.range(1), []),
    ):
        with pytest.raises(ValueError):
            make()


def test_length(spark):
    rules = [{"max": 80, "label": "1"}, {"max": 500, "label": "2"}, {"min": 501, "label": "3"}]
    assert labels(spark, ["x" * n for n in (80, 81, 500, 501)], rt.length(rules)) == ["1", "2", "2", "3"]
    assert labels(spark, ["a b  c", "a b"], rt.length([{"min": 3, "label": "l"}], unit="tokens")) == ["l", None]


def test_language(spark):
    texts = ["hello there", "안녕하세요", "123 !!"]
    assert labels(spark, texts, rt.language("translate")) == [None, "translate", None]
    assert labels(spark, texts, rt.language("translate", "chat")) == ["chat", "translate", None]
    df = spark.createDataFrame([("x", "fr", 0.9), ("x", "fr", 0.5), ("x", "en", 0.9)], "text string, lang string, conf double")
    step = rt.language("translate", None, 0.85, "lang", "conf")
    assert [r["label"] for r in rt.route(df, [step]).collect()] == ["translate", None, None]


def test_first_match_wins_and_exhaustion(spark):
    steps = [rt.length([{"max": 3, "label": "tiny"}]), rt.question()]
    assert decide(spark, ["is", "is it", "nothing here"], steps) == [("tiny", "length"), ("chat", "question"), (None, None)]
    df = spark.createDataFrame([("nothing here",)], "text string")
    assert rt.route(df, steps).first()["error"] == "pipeline_exhausted"
    with pytest.raises(Exception, match="pipeline_exhausted"):
        rt.route(df, steps, strict=True).collect()


def test_context_passes_through(spark):
    df = spark.createDataFrame([("x", {"session_id": "1"})], "text string, context map<string,string>")
    assert rt.route(df, [rt.always()]).first()["context"] == {"session_id": "1"}


def test_classifier_sees_only_open_rows(spark):
    seen = []

    def score(df):
        seen.append(sorted(r["text"] for r in df.filter("text IS NOT NULL").collect()))
        label = F.when(F.col("text") == "b", "from model")
        return df.withColumns({"label": label, "confidence": F.lit(0.7)})

    df = spark.createDataFrame([("is a",), ("b",), ("c",)], "text string")
    mapping = spark.createDataFrame([("from model", "mapped")], "from_label string, to_label string")
    out = rt.route(df, [rt.question(), rt.classifier(score, mapping), rt.always()])
    assert seen == [["b", "c"]]
    assert rows(out.select("text", "label", "method", "confidence")) == [
        ("b", "mapped", "classifier", 0.7), ("c", "default", "always", 1.0), ("is a", "chat", "question", 1.0),
    ]


def test_random_classifiers_keep_every_row_once(spark):
    """Two batch scorers that answer at random: one pass, no row lost or doubled, no row asked twice by a step."""
    asked = spark.sparkContext.accumulator(0)

    def score(df):
        def run(frames):
            import random

            for pdf in frames:
                asked.add(len(pdf))
                pdf["label"] = [random.choice(["x", None]) if t is not None else None for t in pdf["text"]]
                pdf["confidence"] = 0.5
                yield pdf

        return df.mapInPandas(run, "request_id long, __decision struct<label:string,confidence:double,text:string,"
                              "method:string>, text string, __text string, label string, confidence double")

    df = spark.range(2000).selectExpr("id AS request_id", "'t' || id AS text", "'e' AS error")

    def scorer(frame):
        return score(frame.select("request_id", "__decision", "text", "__text"))

    out = rt.route(df, [rt.prefix([("t1", "one")]), rt.classifier(scorer), rt.classifier(scorer, method="second"), rt.always()])
    got = out.select("request_id", "label", "method").collect()
    assert sorted(r.request_id for r in got) == list(range(2000))
    assert asked.value == 4000
    assert {r.method for r in got} == {"prefix", "classifier", "second", "always"}
    assert out.columns == ["request_id", "text", "label", "method", "confidence", "error"]


def test_explain_with_a_classifier_step(spark):
    def score(df):
        return df.withColumns({"label": F.when(F.col("text") == "b", "mine"), "confidence": F.lit(0.9)})

    df = spark.createDataFrame([(1, "is a"), (2, "b"), (3, "c")], "request_id int, text string")
    got = rt.explain(df, [rt.question(), rt.classifier(score), rt.always()]).orderBy("request_id", "step").collect()
    assert [(r.request_id, r.method, r.label, r.reached) for r in got] == [
        (1, "question", "chat", True), (1, "classifier", None, False), (1, "always", "default", False),
        (2, "question", None, True), (2, "classifier", "mine", True), (2, "always", "default", False),
        (3, "question", None, True), (3, "classifier", None, True), (3, "always", "default", True),
    ]


def test_validate_route(spark):
    steps = [rt.regex([("(", "a"), ("ok", "b")]), rt.always(), rt.question()]
    faults = rt.validate_route(steps, ["b"])
    assert len(faults) == 3
    assert "never reached" in " ".join(faults) and "does not compile: (" in " ".join(faults) and "label a" in " ".join(faults)
    assert rt.validate_route([rt.regex([("ok", "b")]), rt.always()], ["b"]) == []
    assert rt.validate_route([]) == ["a route needs at least one step"]


def test_route_is_one_projection(spark):
    df = spark.createDataFrame([("x",)], "text string")
    steps = [rt.prefix([("/a", "a")]), rt.code_block(), rt.question(), rt.keyword([(["k"], "k")]), rt.always()]
    shown = plan(rt.route(df, steps))
    assert "Exchange" not in shown and "Python" not in shown


def test_explain(spark):
    df = spark.createDataFrame([(1, "is it")], "request_id long, text string")
    got = rt.explain(df, [rt.code_block(), rt.question(), rt.always()]).orderBy("step")
    assert [tuple(r)[1:] for r in got.collect()] == [
        (0, "code_block", False, None, True), (1, "question", True, "chat", True), (2, "always", True, "default", False),
    ]


# --- health -----------------------------------------------------------------------------


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def health_table(spark, *checks):
    return spark.createDataFrame([(b, at(s), up) for b, s, up in checks], "backend string, checked_at timestamp, up boolean")


ROUTES = [("code", ["x", "y"]), ("edit", ["y"]), ("default", ["z"])]


def resolve(spark, labels, health, **options):
    routes = spark.createDataFrame(ROUTES, "label string, backends array<string>")
    decisions = spark.createDataFrame([(label, None) for label in labels], "label string, error string")
    status = hl.backend_status(health, F.lit(at(100)).cast("timestamp"), 60)
    out = hl.resolve_backends(decisions, routes, status, **options)
    return [(r["backend"], r["fallback_used"], r["error"]) for r in out.collect()]


def test_fallback_chain(spark):
    first_down = health_table(spark, ("x", 90, False), ("y", 90, True))
    assert resolve(spark, ["code"], first_down) == [("y", True, None)]
    all_down = health_table(spark, ("x", 90, False), ("y", 90, False))
    assert resolve(spark, ["code", "edit"], all_down) == [(None, False, "no_backends_available")] * 2
    expired = health_table(spark, ("x", 39, False))
    assert resolve(spark, ["code"], expired) == [("x", False, None)]
    assert resolve(spark, ["code"], health_table(spark, ("x", 40, False))) == [("y", True, None)]
    future = health_table(spark, ("x", 90, True), ("x", 101, False))
    assert resolve(spark, ["code"], future) == [("x", False, None)]


def test_unknown_route(spark):
    none = health_table(spark, ("q", 1, True))
    assert resolve(spark, ["openai"], none) == [(None, False, "unknown_route")]
    assert resolve(spark, ["openai"], none, default_route="default") == [("z", False, None)]
    assert resolve(spark, ["code"], none, unknown="down") == [(None, False, "no_backends_available")]


@pytest.mark.parametrize("rows_per_task", [1, 2, 10_000])
def test_asof_equals_brute_force(spark, rows_per_task):
    """One backend takes most requests, many of them at one instant."""
    checks = [("a", s, s % 3 > 0) for s in range(0, 400, 7)] + [("b", 10, False), ("b", 300, True)]
    asked = [(i, "a", 120 if i % 2 else (i * 13) % 500) for i in range(300)] + [(300 + i, "b", i * 10) for i in range(50)]
    asked += [(900, "c", 5), (901, "a", 0)]
    requests = spark.createDataFrame([(i, b, at(s)) for i, b, s in asked], "request_id long, backend string, ts timestamp")
    got = hl.health_asof(requests, health_table(spark, *checks), 60, rows_per_task=rows_per_task)
    want = []
    for i, backend, second in asked:
        fit = [(s, up) for b, s, up in checks if b == backend and second - 60 <= s <= second]
        want.append((i, max(fit)[1] if fit else True))
    assert sorted((r["request_id"], r["up"]) for r in got.collect()) == sorted(want)

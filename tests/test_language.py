"""Language profiles against a plain version."""

import random
from collections import Counter, defaultdict

import pytest

from labelloom.operators import language as lg
from labelloom.operators import routing as rt

ALPHABETS = {"en": "thequickbrown ", "es": "elníñoquería ", "de": "dieüberßtraße "}


def texts(seed, n=60):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choices(ALPHABETS[lang], k=rng.randrange(1, 80))), lang) for i in range(n) for lang in [rng.choice(list(ALPHABETS))]]
    return [*rows, (900, None, "en"), (901, "", "en"), (902, "nobody's", None), (903, "日本", "en"), (904, "ZZ", "de")]


def grams(text, sizes=lg.SIZES):
    return [text.lower()[i : i + n] for n in sizes for i in range(len(text) - n + 1)]


def plain_profiles(rows, top):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        if lang is not None and text is not None:
            counts[lang].update(grams(text))
    return {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:top]] for lang, c in counts.items()}


def plain_score(profiles, text, top):
    held = set(grams(text or ""))
    points = sorted((-sum(top - r for r, g in enumerate(p) if g in held), lang) for lang, p in profiles.items())
    points = [(-n, lang) for n, lang in points if n]
    if not points:
        return None, 0.0
    return points[0][1], (points[0][0] - (points[1][0] if len(points) > 1 else 0)) / points[0][0]


@pytest.mark.parametrize("top, held", [(300, 200_000), (20, 15)])
def test_profiles_and_scores(spark, monkeypatch, top, held):
    monkeypatch.setattr(lg, "HELD", held)
    rows = texts(top)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = plain_profiles(rows, top)
    got = defaultdict(dict)
    for r in lg.gram_ranks(df, top=top).collect():
        got[r.lang][r.rank] = r.gram
    assert {lang: [ranks[k] for k in sorted(ranks)] for lang, ranks in got.items()} == want
    asked = texts(top + 1)
    scored = lg.train_profiles(df, top=top).scores(spark.createDataFrame(asked, df.schema)).collect()
    for r in scored:
        lang, sure = plain_score(want, r.text, top)
        assert (r.lang_pred, r.lang_confidence) == (lang, pytest.approx(sure)), r.text


def test_language_step(spark):
    df = spark.createDataFrame(texts(5, 200), "doc_id long, text string, lang string")
    step = lg.language_by_profiles(lg.train_profiles(df), "translate", "english", 0.05)
    asked = spark.createDataFrame([(1, "the quick brown"), (2, "el niño quería"), (3, "die über straße"), (4, ""), (5, None)], "request_id long, text string")
    out = {r.request_id: (r.label, r.method) for r in rt.route(asked, [step, rt.always()]).collect()}
    assert out[1] == ("english", "language") and out[2] == out[3] == ("translate", "language")
    assert out[4][1] == "always" and out[5][1] == "always"


def test_profiles_have_a_bound(spark, monkeypatch):
    df = spark.createDataFrame(texts(6), "doc_id long, text string, lang string")
    monkeypatch.setattr(lg, "MAX_ENTRIES", 30)
    with pytest.raises(ValueError, match="30"):
        lg.train_profiles(df)
    assert lg.gram_ranks(df.limit(0)).collect() == []


def test_profiles_are_counted_and_scored_without_a_step_for_each_character():
    """Same counts and points as by slices, in a fraction of the Python steps: texts of odd letters, and more letters than fit a dense table."""
    import random
    import sys
    from collections import Counter, defaultdict

    rng = random.Random(3)
    texts = ["", "a", "ab\0c\0", "\U0001f600x\U0001f600", *["".join(rng.choice("abcdé ß日") for _ in range(rng.randrange(900))) for _ in range(40)]]
    texts.append("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(4000)))

    def grams(text, sizes=(1, 2, 3)):
        return [text[i : i + n] for n in sizes for i in range(len(text) - n + 1)]

    want, got = Counter(g for t in texts for g in grams(t)), Counter()
    for lo, hi in lg._slabs(texts):
        for gram, n in lg._gram_counts(texts[lo:hi], (1, 2, 3)):
            got[gram] += n
    assert got == want
    entries = {g: [(lang, rng.randrange(1, 300)) for lang in rng.sample("xyz", rng.choice([1, 2]))] for g in rng.sample(sorted(want), 800)}
    found = lg._Finder(entries)
    lines = [0]

    def trace(frame, event, _):
        frame.f_trace_opcodes = False
        lines[0] += event == "line"
        return trace

    sys.settrace(trace)
    try:
        points = found.scores(texts)
    finally:
        sys.settrace(None)
    assert lines[0] < sum(map(len, texts)) / 10
    for text, row in zip(texts, points, strict=True):
        sums = defaultdict(int)
        for gram in set(grams(text)):
            for lang, n in entries.get(gram, ()):
                sums[lang] += n
        assert [sums[lang] for lang in found.langs] == row.tolist()

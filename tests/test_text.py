"""Hand-made cases of the text functions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.functions import text as tx
from labelloom.functions.draws import draw, pick_weighted, unit
from labelloom import fixed_values as fv
from tests.conftest import plan


def one(spark, text, make):
    return spark.createDataFrame([(1, text)], "id long, text string").select(make(F.col("text"), F.col("id"))).first()[0]


def slots(**lists):
    return F.create_map(
        *[x for k, v in lists.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]).cast("array<string>"))]
    )


def test_draw_value(spark):
    assert spark.range(1).select(draw(42, F.lit(7), "lang")).first()[0] == 998210071


def test_draws_follow_the_weights(spark):
    n = 20_000
    kinds = spark.range(n).select(pick_weighted(fv.CONV_TYPES, unit(1, F.col("id"), "conv_type")).alias("k"))
    counts = Counter(r["k"] for r in kinds.collect())
    for kind, share in fv.CONV_TYPES:
        sigma = (n * share * (1 - share)) ** 0.5
        assert abs(counts[kind] - n * share) < 4 * sigma


@pytest.mark.parametrize(
    "text, want",
    [
        ("no slots", "no slots"),
        ("{a}", "x"),
        ("{a} and {a}!", "x and x!"),
        ("{unknown} {empty}", "{unknown} {empty}"),
        ("pre {a}{a} post", "pre xx post"),
        ("", ""),
    ],
)
def test_fill_slots(spark, text, want):
    assert one(spark, text, lambda t, k: tx.fill_slots(t, slots(a=["x"], empty=[]), 42, k)) == want


def test_slots_are_picked_independently(spark):
    many = slots(a=[str(i) for i in range(50)])
    out = one(spark, "{a} " * 30, lambda t, k: tx.fill_slots(t, many, 42, k))
    assert len(set(out.split())) > 10


def test_typo_without_long_words_is_unchanged(spark):
    assert one(spark, "a  bb  ccc", lambda t, k: tx.typo(t, 42, k)) == "a  bb  ccc"


def test_typo_swaps_one_pair(spark):
    for seed in range(20):
        out = one(spark, "abcd", lambda t, k: tx.typo(t, seed, k))
        assert out in ("bacd", "acbd", "abdc")
        korean = one(spark, "  가나다라 x", lambda t, k: tx.typo(t, seed, k))
        assert korean in ("나가다라 x", "가다나라 x", "가나라다 x")


def test_abbreviate_needs_the_bare_word(spark):
    words = " ".join(["Variable,"] * 200 + ["Variable"] * 400)
    out = one(spark, words, lambda t, k: tx.abbreviate(t, slots(variable=["var", "v"]), 42, k)).split()
    assert out[:200] == ["Variable,"] * 200
    changed = [w for w in out[200:] if w != "Variable"]
    assert 5 <= len(changed) <= 45 and set(changed) <= {"var", "v"}


def test_filler_goes_anywhere(spark):
    places = set()
    for seed in range(60):
        out = one(spark, "a b", lambda t, k: tx.filler_insert(t, F.lit("um"), seed, k))
        places.add(out)
    assert places == {"um a b", "a um b", "a b um"}
    assert one(spark, "a  b", lambda t, k: tx.filler_insert(t, F.lit(None).cast("string"), 1, k)) == "a  b"


def test_reply_lines(spark):
    reply = "1. foo\n- bar\r\n* baz\n\n   \n2. - qux\n3.nospace\n-- x"
    assert one(spark, reply, lambda t, k: tx.reply_lines(t)) == ["foo", "bar", "baz", "qux", "3.nospace", "-- x"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("```json\n{}\n```\nrest", "{}"),
        (" ```\na\nb", "a\nb"),
        ("plain ```", "plain ```"),
        ("```", ""),
        ("```\n ``` ", ""),
    ],
)
def test_strip_fence(spark, text, want):
    assert one(spark, text, lambda t, k: tx.strip_fence(t)) == want


@pytest.mark.parametrize("text", ["", "abc", "é" * 300, "x" * 600, "a\x00b", "가나다" * 100 + "😀" * 40])
def test_byte_encode(spark, text):
    raw = list(text.encode("utf-8"))[:512]
    assert one(spark, text, lambda t, k: tx.byte_encode(t)) == raw + [0] * (512 - len(raw))


@pytest.mark.parametrize("text", ["", "ab", "abc", "abcabcabc", "가나다라 마바", "z" * 700])
def test_ngram_buckets(spark, text):
    raw = text.encode("utf-8")
    want = set()
    for i, n in enumerate(fv.NGRAM_SIZES):
        for at in range(len(raw) - n + 1):
            want.add(int.from_bytes(raw[at : at + n], "big") % 1000 + i * 1000)
    got = one(spark, text, lambda t, k: tx.ngram_buckets(t, buckets=1000))
    assert sorted(got) == sorted(want)


def test_unicode_white_space(spark):
    assert one(spark, " a　b\x1cc \n", lambda t, k: tx.words(t)) == ["a", "b", "c"]
    assert one(spark, "  a b  ", lambda t, k: tx.strip(t)) == "a b"


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "x array<double>")
    assert df.select(tx.argmax(F.col("x"))).first()[0] == 1
    shares = df.select(tx.softmax(F.col("x"))).first()[0]
    assert sum(shares) == pytest.approx(1.0) and shares[1] == shares[2]


def test_text_functions_run_without_python(spark):
    df = spark.createDataFrame([(1, "some text")], "id long, text string")
    text, key = F.col("text"), F.col("id")
    out = df.select(
        tx.typo(text, 1, key), tx.to_question(text, 1, key), tx.ngram_buckets(text), tx.reply_lines(text)
    )
    assert "Python" not in plan(out)

"""The mix of sources, phrase collocations and lexical search against plain versions."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from labelloom.llm import collocations as phrases
from labelloom.llm import lexical, mixing

#: Columns whose names the operators use or return.
CLASHING = {"n": 1, "size": 2, "taken": 3, "bucket": 4, "p": 5, "row": 6, "item": 7, "weight": 8, "budget": 9}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- the mix -----------------------------------------------------------------------------------


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target}: all sizes shared by weight, with what is too much for a source shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    open_, out, left = set(order), {}, sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if Fraction(left * weight[s], total) >= most * sizes[s]]
        if not full:
            out.update({s: Fraction(left * weight[s], total) for s in open_})
            break
        for s in full:
            out[s] = Fraction(most * sizes[s])
            open_.remove(s)
        left -= sum(most * sizes[s] for s in full)
    return out


def mix_table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({name: F.lit(value) for name, value in CLASHING.items()}).repartition(3)


def mix_rows(seed):
    rng = random.Random(seed)
    rows = [(i, "w " * min(4000, int(rng.paretovariate(1) * 5)), f"s{rng.randrange(4)}") for i in range(400)]
    rows += [(1000 + i, "x\ty\n" * 3, "hot") for i in range(800)]
    rows += [(7, "the same words", "copies")] * 300 + [(None, "the same words", None)] * 200
    rows += [(5000, None, "s1"), (5001, " \n", "blank"), (5002, "", None), (5003, "one long " * 500, "alone")]
    return rows


@pytest.mark.parametrize("bucket_rows, edge_rows", [(512, 8192), (2, 6)])
def test_mix(spark, monkeypatch, bucket_rows, edge_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(mixing, "EDGE_ROWS", edge_rows)
    rows = mix_rows(1)
    docs = mix_table(spark, rows)
    got = mixing.mix(docs, keep=("doc_id", "source", "size")).collect()
    sizes, taken = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += size_of(text)
    want = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, size_of(t)) for i, t, s in rows)
    times = {}
    for r in got:
        taken[r.source] += r.taken
        assert r.taken == r.times * r.size <= 3 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6)
        if r.size:
            times.setdefault(r.source, set()).add(r.times)
    assert abs(sum(want.values()) - sum(sizes.values())) < 1
    for source, target in want.items():
        if not sizes[source]:
            continue
        own = [r for r in got if r.source == source and r.size]
        fewest = [r.size for r in own if r.times == min(times[source])]
        near = min(fewest) if edge_rows > 6 else max(r.size for r in own)  # small buckets have few documents to choose from
        assert abs(taken[source] - target) <= near, source
        assert max(times[source]) - min(times[source]) <= 1
    again = mixing.mix(docs.repartition(5), keep=("doc_id", "source", "size")).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_takes_by_key(spark):
    """With one bucket: all below the boundary in the order of the keys, as far as they fit, and the smallest left if that comes nearer."""
    rows = [(i, "w " * (1 + i * 7 % 50), "a" if i % 3 else "b") for i in range(120)]
    docs = mix_table(spark, rows)
    keys = {r["doc_id"]: r["__key"] for r in mixing.sized(docs, ("doc_id",)).collect()}
    got = {r.doc_id: r.times for r in mixing.mix(docs).collect()}
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size_of(text)
    for source, target in plain_targets(sizes).items():
        every = target // sizes[source]
        left = target - every * sizes[source]
        own = sorted((keys[i], size_of(t), i) for i, t, s in rows if s == source)
        more = set()
        for _, size, i in own:
            if size <= left:
                more.add(i)
                left -= size
        rest = min(((size, key, i) for key, size, i in own if i not in more), default=None)
        if rest and rest[0] - left < left:
            more.add(rest[2])
        assert {i: got[i] for _, _, i in own} == {i: every + (i in more) for _, _, i in own}


def test_mix_broadcast_and_salted_joins_agree(spark, monkeypatch):
    docs = mix_table(spark, mix_rows(2))
    got = mixing.mix(docs).collect()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs).collect()))


def test_mix_odd_tables(spark):
    assert mixing.mix(mix_table(spark, [])).collect() == []
    only = mixing.mix(mix_table(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in only) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    copies = mixing.repeated(mixing.mix(mix_table(spark, [(1, "a b", "a"), (2, "c d e f g h i j", "b"), (3, None, "c")])))
    assert Counter(r.doc_id for r in copies.collect())[1] <= 3


# --- collocations ------------------------------------------------------------------------------


def plain_collocations(rows, least, share=80, best=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    longer = Counter()
    for (lang, p), a in candidates.items():
        for n in range(2, len(p)):
            for at in range(len(p) - n + 1):
                longer[lang, p[at : at + n]] = max(longer[lang, p[at : at + n]], a)
    out = []
    for lang in totals:
        own = []
        for (tongue, p), a in candidates.items():
            if tongue == lang and 100 * longer[lang, p] < share * a:
                cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
                score, _, (left, right) = min((2000000 * a // (x + y), k, (x, y)) for k, (x, y) in enumerate(cuts))
                own.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["Ünder", "über", "UND", "a\x01b"]
    rows = []
    for _ in range(120):
        lang = rng.choice(["en", "de", None, "und"])
        words = [rng.choice(vocabulary[: rng.choice([5, 29])]) for _ in range(rng.randrange(40))]
        glue = [rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "! ", "\x0b"]) for _ in words]
        rows.append((lang, "".join(a + b for a, b in zip(words, glue, strict=True))))
    rows += [("en", "New York City Hall is big.")] * 9 + [("de", None), (None, ""), ("fr", " \t,;"), ("xx", "so so so so so so so so so so so so")]
    rng.shuffle(rows)
    return rows


def phrase_table(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    return df.withColumns({name: F.lit(value) for name, value in CLASHING.items()}).repartition(3)


@pytest.mark.parametrize("burst, held, bits", [(4096, 300_000, 1 << 20), (3, 40, 1 << 15)])
def test_collocations(spark, monkeypatch, burst, held, bits):
    monkeypatch.setattr(phrases, "BURST", burst)
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "FEWEST_BITS", bits)
    monkeypatch.setattr(phrases, "MOST_BITS", bits)
    rows = phrase_rows(burst)
    got = phrases.collocations(phrase_table(spark, rows), least=6).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 6)
    assert got[0].asDict().keys() == {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}
    few = phrases.collocations(phrase_table(spark, rows), least=6, best=3).collect()
    assert sorted(map(tuple, few)) == plain_collocations(rows, 6, best=3)


def test_collocations_odd_tables(spark):
    assert phrases.collocations(phrase_table(spark, [])).collect() == []
    assert phrases.collocations(phrase_table(spark, [("en", None), (None, " .")])).collect() == []
    long = phrases.collocations(phrase_table(spark, [(None, "a b " * 50_000)])).collect()
    assert [tuple(r) for r in long] == plain_collocations([(None, "a b " * 50_000)], 30)


def test_trie_counts_and_spills_in_order():
    rng = random.Random(3)
    trie, want, spilled = phrases.Trie(), Counter(), Counter()
    phrases_, phrases.BURST = phrases.BURST, 4
    try:
        for _ in range(3):
            keys = [bytes(rng.choice([0, 1, 255]) for _ in range(8)) for _ in range(300)]
            trie.add(keys, [1] * 300)
            want.update(keys)
            run = list(trie.spill(60))
            assert trie.held <= 60
            for first in {k[0] for k, _ in run}:  # a run of one subtree is sorted
                own = [k for k, _ in run if k[0] == first]
                assert own == sorted(own)
            spilled.update(dict(run))
        spilled.update(dict(trie.spill(0)))
    finally:
        phrases.BURST = phrases_
    assert spilled == want and trie.held == 0


# --- lexical search ------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(lower(text)))) for i, text in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    n, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item_id, text in items:
        wanted, scored = TERM.findall(lower(text)), []
        for i, bag in bags:
            m = 100 - 75 + 75 * sum(bag.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in wanted
                if bag[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if none else i, -score))
    return out


def search_tables(spark, docs, items, parts=4):
    extra = {name: F.lit(value) for name, value in CLASHING.items()}
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns(extra).repartition(parts)
    return left, spark.createDataFrame(items, "item_id long, text string").withColumns(extra)


def search_rows(seed):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(300)] + ["Ñu", "ñu", "x_y", "Ab", "aB"]

    def text(n):
        return "".join(rng.choice(words[: rng.choice([10, 305])]) + rng.choice([" ", "-", "\n", "\x00", ". "]) for _ in range(n))

    items = [(i, text(rng.randrange(1, 30))) for i in range(30)] + [(31, ""), (32, None), (33, "...")]
    docs = [(i, text(rng.randrange(0, 120))) for i in range(300)]
    docs += [(400 + i, text(5) + items[i % 5][1] + text(10)) for i in range(40)]
    docs += [(500 + i, items[0][1]) for i in range(30)] + [(-4, items[0][1]), (7, items[0][1]), (7, items[0][1]), (None, items[0][1])]
    docs += [(600, None), (601, "  "), (602, "t1 " * 3_000), (603, "t2 " * 254 + "t3 " * 255 + "t4 " * 256)]
    return docs, items + [(40, "t1 t1 t2 t3 t4 t4 unknown")]


@pytest.mark.parametrize("k, spread, block", [(10, 4, 256), (3, 1, 7)])
def test_search(spark, monkeypatch, k, spread, block):
    monkeypatch.setattr(lexical, "SPREAD", spread)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    docs, items = search_rows(k)
    got = lexical.search(*search_tables(spark, docs, items), k).collect()
    want = plain_search(docs, items, k)
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == want
    assert {x[0] for x in want} >= {0, 1, 40} and not {31, 32, 33} & {x[0] for x in want}


def test_search_odd_tables(spark):
    docs, items = search_rows(1)
    assert lexical.search(*search_tables(spark, [], items)).collect() == []
    assert lexical.search(*search_tables(spark, docs, [])).collect() == []
    assert lexical.search(*search_tables(spark, [(1, None), (2, "-")], items)).collect() == []
    assert lexical.search(*search_tables(spark, docs, [(1, None)])).collect() == []
    twice = [(5, "t1 t2"), (5, "t9"), (None, "t1 t2")]  # items of their own, whatever their ids
    got = lexical.search(*search_tables(spark, docs, twice)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_search(docs, twice), key=str)


def test_lengths_beyond_64_bits():
    n = lexical.np.array([10**7, 5])
    documents, terms = 10**11, 10**13
    assert lexical.long_lengths(n, documents, terms).tolist() == [25 + 75 * int(x) * documents // terms for x in n]

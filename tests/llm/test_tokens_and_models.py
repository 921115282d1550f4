import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelloom.llm import bpe, packing, quality, queries, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello  wörld's 12 3\n!!??", "Ⅷ İstanbul ſ Á ǅ", "<|endoftext|> x <|startoftext|>hi<|endoftext|>", "日本語 ​ a\x00b\x1cc d\x85e\xa0f",
    "naïve ΑΣ Σ", " ' s 's don't'll I'M", "", None, "a" * 3000, "ab" * 700 + "!" * 900, "é ́x x̣́", "<|ENDOFTEXT|>", "한글 각", "word " * 9000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def table(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return df.withColumns({c: F.lit(1) for c in ("ids", "piece", "length", "offset", "label", "n_chars")}).repartition(2)


def test_encoder_is_exact(library):
    mine = bpe.encoder(open(PATH, "rb").read())
    rng = random.Random(5)
    letters, shown = "abcdefghinorstuélñß'.,!0123 \n\tABΣİ<|>é", list(mine.shown.values())
    cases = [t or "" for t in TEXTS]
    cases += ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(500)]
    cases += ["".join(rng.choice(shown).replace("</w>", "") for _ in range(rng.randint(1, 5))) for _ in range(2000)]
    for text in cases:
        want = library.encode(text, add_special_tokens=False)
        got = np.frombuffer(mine.encode(text.encode()), "<u4").astype(np.int64)
        assert list(got) == want.ids
        assert mine.decode(got).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_encode_and_pack(spark, library):
    docs = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id")]
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in docs}
    got = bpe.encode(table(spark, docs), PATH, decoded=True).collect()
    assert len(got) == len(docs)
    for r in got:
        assert list(np.frombuffer(r.ids, "<u4")) == want[r.doc_id]
        assert r.decoded.decode() == library.decode(want[r.doc_id], skip_special_tokens=False)

    pieces = packing.pack_documents(table(spark, docs), PATH).collect()
    seen, sequences = [], {}
    for r in pieces:
        ids = np.array([*want[r.doc_id], 0], "<u4")
        part = ids[r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and len(part) == r.length and (r.length == 2048 or r.start + r.length == len(ids))
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        seen.append((str(r.doc_id), r.piece))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(seen) == sum(-(-(len(want[i]) + 1) // 2048) for i, _ in docs)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in pieces) // 2048)
    assert packing.pack_documents(table(spark, []), PATH).collect() == []
    assert bpe.encode(table(spark, []), PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_whole_and_tight(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 100, 2048])
    counts = {length: rng.randrange(1, 200) for length in rng.sample(range(1, capacity + 1), min(capacity, 150))}
    plan = packing.plan_packing(counts, capacity)
    got = {}
    for content, times in plan:
        assert sum(content) <= capacity and times > 0
        for length in content:
            got[length] = got.get(length, 0) + times
    assert got == counts
    bins = sum(t for _, t in plan)
    rooms: list[int] = []  # best fit, longest first, piece by piece
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    assert -(-sum(k * v for k, v in counts.items()) // capacity) <= bins <= len(rooms)
    for length, n in counts.items():
        ranks = sorted((a, b) for k, a, b, *_ in packing.runs_of(plan) if k == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == n - 1 and all(x[1] + 1 == y[0] for x, y in zip(ranks, ranks[1:], strict=False))
    assert packing.plan_packing({}, capacity) == []


def _accuracy(rows, labels, predicted, label):
    pairs = [(r[predicted], labels[r.doc_id][label]) for r in rows if r.doc_id in labels]
    return sum(a == b for a, b in pairs) / len(pairs)


@pytest.fixture(scope="module")
def held_labels(spark):
    labels = queries.table(spark, "/root/testdata/sf0.01", "labels").filter(queries.held_out())
    return {r.doc_id: r for r in labels.collect()}


def test_quality_is_right_on_held_out_rows(spark, held_labels):
    rows = queries.op9_quality(spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert _accuracy(rows, held_labels, "predicted", "quality") >= 0.97


def test_toxicity_is_right_on_held_out_rows(spark, held_labels):
    rows = queries.op3_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert _accuracy(rows, held_labels, "toxic", "toxic") >= 0.93


def test_models_take_odd_rows(spark):
    docs = table(spark, [(1, None), (2, ""), (2, ""), (3, "one two"), (None, "x"), (4, "long " * 20_000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    blank = quality.score(docs, quality.train(docs, none, "quality", ("n_chars",)), ("n_chars",)).collect()
    assert [r["__score"] for r in blank] == [0.5] * 6
    assert {r.p_toxic for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    some = spark.createDataFrame([(1, 1, 1), (3, 0, 0), (4, None, None), (9, 1, 1), (2, 1, 1)], none.schema)
    scored = quality.score(docs, quality.train(docs, some, "quality"), keep=("doc_id", "label", "ids")).collect()
    assert len(scored) == 6 and all(0 <= r["__score"] <= 1 for r in scored)
    assert toxicity.score(docs, toxicity.train(docs, some)).count() == 6
    empty = table(spark, [])
    assert quality.score(empty, quality.train(empty, some, "quality")).collect() == []
    assert toxicity.score(empty, toxicity.train(empty, some)).collect() == []


def test_chain_uses_earlier_categories():
    """The last category is the earlier one: the chain must carry it over."""
    rng = np.random.default_rng(0)
    held = [np.unique(rng.integers(0, 30, 6)) for _ in range(300)]
    first = np.array([float(3 in h) for h in held])
    chain = toxicity.Chain.fit(held, np.column_stack([first, first]), 30)
    sizes = np.array([len(h) for h in held])
    scores = chain.scores(np.repeat(np.arange(300), sizes), np.concatenate(held), 300)
    assert ((scores[:, 1] > 0.5) == first).mean() == 1 and chain.models[1].d[0] > 0.5

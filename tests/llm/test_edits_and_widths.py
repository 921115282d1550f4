"""Least length and white space in line dedup, lines seen once by a task, and n-gram joins below 50 percent."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom.llm import line_dedup, ngram_join

from . import brute
from .test_text_operators import WORDS, table


def lines_table(seed):
    rng = random.Random(seed)
    docs = []
    base = [rng.choices(WORDS, k=n) for n in (2, 3, 4, 5, 7, 8, 9, 30)]
    for i in range(60):
        out = []
        for words in rng.sample(base, 3):
            own = list(words)
            for _ in range(rng.randrange(3)):  # none, one or two edits
                at = rng.randrange(len(own))
                kind = rng.randrange(4)
                if kind == 0:
                    own[at] = rng.choice(WORDS)
                elif kind == 1:
                    own.insert(at, rng.choice(WORDS))
                elif kind == 2 and len(own) > 1:
                    own[at : at + 2] = ["".join(own[at : at + 2])]  # a lost space
                else:
                    own[at] = own[at].upper()
            out.append(rng.choice([" ", "  ", "\t"]).join(own))
        docs.append((i, "\n".join(out)))
    return docs


@pytest.mark.parametrize("least, seen", [(2, 100_000), (5, 2), (8, 100_000)])
def test_repeated_lines_by_least_length(spark, monkeypatch, least, seen):
    monkeypatch.setattr(line_dedup, "SEEN", seen)
    docs = lines_table(least)
    got = {(r.doc_id, r.number): r.near for r in line_dedup.repeated_lines(table(spark, docs), least).collect()}
    assert got == brute.repeated_lines(docs, least)
    assert any(got.values())


def test_lost_spaces_are_near_copies(spark):
    line = "one two three four five six seven eight nine"
    docs = [(1, line), (2, line.replace("two three", "twothree")), (3, line.replace(" ", "\t ")), (4, line.replace("six", "sixty six"))]
    docs += [(5, "a b c"), (6, "ab c"), (7, "a  b c")]  # short lines must be equal in their words
    got = {(r.doc_id, r.number): r.near for r in line_dedup.repeated_lines(table(spark, docs)).collect()}
    assert got == {(2, 0): True, (3, 0): False, (4, 0): True, (7, 0): False}
    with pytest.raises(ValueError):
        line_dedup.repeated_lines(table(spark, docs), 1)


def test_a_task_emits_the_variants_of_a_line_once(spark):
    """A line that many documents share makes a row for each word and task, not for each document."""
    line, other = " ".join(WORDS[:12]), " ".join([*WORDS[:11], "other"])
    docs = spark.createDataFrame([(i, f"{line}\n{' '.join(WORDS[i : i + 9])}") for i in range(300)] + [(900, other)], "doc_id long, text string")
    every = spark.sparkContext.broadcast(line_dedup.np.full(1 << 21, 255, line_dedup.np.uint8))
    rows = docs.coalesce(1).mapInArrow(line_dedup._variants(every, None, 8), line_dedup._VARIANT)
    assert rows.groupBy("key", "place", "line").count().agg(F.max("count")).first()[0] == 1
    got = {r.doc_id for r in line_dedup.repeated_lines(docs.repartition(3)).filter("number = 0").collect()}
    assert got == {*range(1, 300), 900}


def test_sets_of_distant_widths_are_linked(spark):
    rng = random.Random(4)
    words = [f"u{i}" for i in range(2052)]
    rng.shuffle(words)
    docs = [(1, " ".join(words)), (2, " ".join(words[:1027])), (3, " ".join(words[:700])), (4, "else " * 5)]
    assert len(brute.shingle_set(docs[1][1])) == 1023 and len(brute.shingle_set(docs[0][1])) == 2048
    for percent, want in ((45, {1: 1, 2: 1, 3: 1, 4: 4}), (30, {1: 1, 2: 1, 3: 1, 4: 4}), (60, {1: 1, 2: 2, 3: 2, 4: 4})):
        got = ngram_join.jaccard_components(table(spark, docs), percent=percent, cells=1 << 16).collect()
        assert {r.doc_id: r.component_id for r in got} == want, percent

"""Line dedup and the stage of near copies leave texts where they are; bitmaps of any quality give the same rows."""

import glob
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import bitmaps, line_dedup
from labelloom.llm.scratch import shared_folder

from . import brute
from .test_edits_and_widths import lines_table
from .test_text_operators import WORDS, table

SF = "/root/testdata/sf0.001"


def left_texts(docs):
    gone = brute.repeated_lines([d for d in docs if None not in d])
    out = []
    for i, text in docs:
        if text is None or i is None:
            out.append((i, text))
            continue
        lost = {k for k in range(len(text.split("\n"))) if (i, k) in gone}
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in lost)
        if not lost or brute.words(left):
            out.append((i, left))
    return sorted(out, key=str)


def scratch(spark, label):
    return set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/{label}-*"))


def test_texts_that_lose_lines_meet_no_join(spark, monkeypatch):
    def failing(*_):
        def run(batches):
            for batch in batches:
                assert not batch.num_rows, "a text was joined"
                yield batch

        return run

    docs = [(i, f"{' '.join(WORDS[:9])}\nown line {i}\n\nlast") for i in range(300)]
    monkeypatch.setattr(line_dedup, "_rewrite", failing)
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(table(spark, docs).select("doc_id", "text")).collect()) == [
        (i, f"own line {i}\n" if i else text) for i, text in docs
    ]


@pytest.mark.parametrize("noise", [0, 0.1, 0.5, 1])
def test_wrong_bits_change_nothing(spark, monkeypatch, noise):
    """``noise``: share of the other bits that are set in all tables."""
    rng = random.Random(7)
    docs = lines_table(11) + [(100 + i, "\n".join(rng.choices(["", " ", "a b", "c d e", "f"], k=6))) for i in range(40)]
    docs += [(None, docs[0][1]), (200, None), (201, ""), (202, " \n ")]

    def noisy(keys, key):
        wrong = np.random.default_rng(3).random(1 << 15) < noise
        return bitmaps.bitmap(keys, key, 1 << 15) | np.packbits(wrong)

    monkeypatch.setattr(line_dedup, "_table", noisy)
    got = line_dedup.dedup_lines(table(spark, docs).select("doc_id", "text").repartition(3)).collect()
    assert sorted([tuple(r) for r in got], key=str) == left_texts(docs)


def test_size_of_bitmaps():
    assert bitmaps.bits_for(0) == bitmaps.bits_for(1) == bitmaps.BITS
    assert bitmaps.bits_for(10**5) == 1 << 25 and bitmaps.bits_for(10**9) == bitmaps.MOST


def test_halves_are_of_one_length_for_neighbours():
    """Of lines with one word more or less, at least one key of a half is the same."""
    rng = random.Random(5)
    for n in range(3, 40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for cut in range(n):
            texts = [" ".join(words), " ".join(words[:cut] + words[cut + 1 :]), " ".join(words[:cut] + ["x"] + words[cut + 1 :])]
            batch = line_dedup.pa.record_batch([line_dedup.pa.array([0]), line_dedup.pa.array(["\n".join(texts)])], ["doc_id", "text"])
            (_, _, _, lines), *_ = line_dedup._chunks(batch)
            keys = [{int(k[i]) for k, real in lines.shared_keys(2) if real[i]} for i in range(3)]
            assert keys[0] & keys[2] and (n == 2 or keys[0] & keys[1]), (n, cut)


def test_near_copies_of_a_file_are_not_written_again(spark):
    before = scratch(spark, "rows")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    assert scratch(spark, "rows") == before
    classes = brute.jaccard_classes([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i in classes if classes[i][1] in (i, None))


def test_numbers_of_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1_000, numPartitions=3).withColumn("text", F.lit("a")).write.parquet(path)
    read = spark.read.parquet(path)
    for docs in (read, read.filter("id % 2 = 0"), read.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), read.unionAll(read),
                 read.limit(0), spark.range(10)):
        numbered = corpus_pipeline._numbered(docs)
        assert numbered.columns == [*docs.columns, "__row"]
        assert numbered.select("__row").distinct().count() == numbered.count() == docs.count()
    rows = corpus_pipeline._numbered(read.coalesce(1)).orderBy("__row").collect()
    assert [r.id for r in rows] == list(range(1_000))

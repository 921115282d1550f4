import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from labelloom.llm import queries

from . import brute

SF = "/root/testdata/sf0.001"


def test_registered_queries(spark):
    names = set(entry.queries())
    assert {q for q in queries.QUERIES} | {"pipeline"} <= names
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for table in ("embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLES[name])
    at = [got.columns.index(d[0]) for d in cursor.description]
    assert sorted(tuple(r[i] for i in at) for r in got.collect()) == sorted(cursor.fetchall())


def test_stages_against_plain_versions(spark):
    """Each stage on what its predecessor kept; the last against the tokens it packs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else kept
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        assert docs.columns == columns
        kept = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in docs.collect()) or name == "quality"
        if name == "quality":
            bad = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 0").fetchall()}
            good = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1").fetchall()}
            assert len(good - set(kept)) <= 0.05 * len(good) and len(bad & set(kept)) <= 0.3 * len(bad) + 1
        elif name == "line_dedup":
            gone = brute.repeated_lines(list(before.items()))
            want = {}
            for i, text in before.items():
                left = "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in gone)
                if brute.words(left) or not brute.words(text):
                    want[i] = left
            assert kept == want
        elif name == "ngram_jaccard":
            classes = brute.jaccard_classes(list(before.items()))
            assert kept == {i: t for i, t in before.items() if classes[i][1] == i}
        elif name == "secret_scan":
            assert set(kept) == set(before)
            for i, text in kept.items():
                assert not brute.spans(text, brute.SECRETS)[0]
                if not brute.spans(before[i], brute.SECRETS)[0]:
                    assert text == before[i]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_near_copies_are_taken_by_row(spark):
    words = [f"v{i}" for i in range(90)]
    w, x = " ".join(words[:40]), " ".join(words[40:80])
    rows = [(5, w, 1, "a"), (5, x, 2, "b"), (3, x + " more", 3, "c"), (7, w, 4, "d"), (5, w, 5, "e"), (None, x, 6, "f"), (9, None, 7, "g"),
            (9, None, 8, "h"), (8, " ", 9, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, mark string").coalesce(1)
    got = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.mark for r in got.collect()) == ["a", "c", "f", "g", "h", "i"]
    assert corpus_pipeline.keep_one_of_near_copies(spark, docs.limit(0), "").collect() == []


def test_stages_of_odd_tables(spark):
    rows = [(1, None, 0, 5), (1, None, 0, 5), (2, "", 0, 6), (None, "some words here", 15, 7), (3, "word " * 5_000, 25_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, length int")
    good = corpus_pipeline.keep_good(spark, docs, SF)
    assert good.columns == docs.columns and good.count() <= 5
    assert corpus_pipeline.keep_good(spark, docs.limit(0), SF).collect() == []
    packed = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.length) for r in packed if r.doc_id != 3) == [(0, 4), (1, 1), (1, 1), (2, 1)]
    assert sum(r.length for r in packed if r.doc_id == 3) == 5_001 and corpus_pipeline.pack_sequences(spark, docs.limit(0), SF).collect() == []


def test_entry_without_what_the_part_needs(monkeypatch):
    """The other queries load when an import of the training-data part fails."""
    import importlib

    real = importlib.import_module

    def failing(name, *rest):
        if name.startswith(("labelloom.llm", "corpus_pipeline")):
            raise ModuleNotFoundError("No module named 'public_tokenizers'", name="public_tokenizers")
        return real(name, *rest)

    monkeypatch.setattr(importlib, "import_module", failing)
    assert "route_prefix" in entry.queries() and "pipeline" not in entry.queries() and "op2_nearest" not in entry.oracle_sql()

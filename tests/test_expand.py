"""Catalogue tables and expansion."""

import json

import pytest
from pyspark.sql import functions as F

from labelloom.operators import expand as ex
from labelloom.sources import catalog as cl
from registry.demo_catalog import DEMO, LANGUAGES
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def demo(spark):
    return cl.catalog_from_dict(spark, DEMO, LANGUAGES)


def test_tables(demo):
    templates = rows(demo.templates.filter("label = 'simple' and lang = 'de'").select("pos", "register", "text"))
    assert templates == [
        (0, "imperative", "nenne die Hauptstadt von {place}"), (1, "imperative", "buchstabiere {word}"),
        (2, "fragment", "Uhrzeit {place}"),
    ]
    langs = {r["label"]: r["langs"] for r in demo.classes.collect()}
    assert langs == {"simple": ["en", "de", "mixed"], "reasoning": ["en", "de"], "agentic": ["en", "de"]}
    assert rows(demo.signals.filter("label_b = 'simple'")) == [
        ("simple", "reasoning", "name the"), ("simple", "reasoning", "no analysis"),
    ]


def test_load_from_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(DEMO, indent=2, ensure_ascii=False), encoding="utf-8")
    loaded = cl.load_catalog(spark, str(tmp_path / "c.json"), LANGUAGES)
    assert loaded.templates.count() == 23  # 13 simple, 6 reasoning, 4 agentic
    assert rows(loaded.bridges.filter("lang = 'mixed'")) == [("mixed", 0, "[INTENT_A] und [INTENT_B]")]


def expanded(spark, catalog, label, kind, n=200):
    return ex.expand_rows(ex.class_seeds(spark, [label], n), catalog, 5, conv_type=kind, rewrite=False).collect()


def test_compound_without_bridge_is_plain(spark, demo):
    for r in expanded(spark, demo, "simple", "E"):
        if r["lang"] == "de":
            assert r["register"] in ("imperative", "fragment") and r["conv_type"] == "E"
        else:
            assert r["register"] == "compound"


def test_fragment_falls_back(spark, demo):
    for r in expanded(spark, demo, "reasoning", "D"):
        assert r["register"] == "fragment" and r["text"]
        if r["lang"] == "en":
            assert " — " in r["text"]


def test_implicit_prefix_is_optional(spark, demo):
    texts = [r["text"] for r in expanded(spark, demo, "reasoning", "F", 400) if r["lang"] == "en"]
    share = sum(" — " in t for t in texts) / len(texts)
    assert 0.4 < share < 0.6


def test_class_without_templates(spark):
    catalog = cl.catalog_from_dict(spark, {"classes": {"a": {"templates": {}}, "b": {}}}, ["fr"])
    got = ex.expand_rows(ex.class_seeds(spark, ["a", "b"], 3), catalog, 1, "A", rewrite=False).collect()
    assert {(r["lang"], r["text"], r["register"]) for r in got} == {("fr", "", "unknown")}


def test_expand_sizes_and_shares(spark, demo):
    n = 3000
    df = ex.expand(spark, demo, list(DEMO["classes"]), n, seed=11).persist()
    assert {r["label"]: r["count"] for r in df.groupBy("label").count().collect()} == dict.fromkeys(DEMO["classes"], n)
    total = 3 * n
    for kind, share in [("A", 0.25), ("D", 0.15), ("F", 0.10)]:
        got = df.filter(F.col("conv_type") == kind).count()
        assert abs(got - total * share) < 4 * (total * share * (1 - share)) ** 0.5
    noised = df.filter("noised").count()
    assert abs(noised - total * 0.2) < 4 * (total * 0.16) ** 0.5
    simple = {r["lang"]: r["count"] for r in df.filter("label = 'simple'").groupBy("lang").count().collect()}
    assert abs(simple["en"] - n * 0.4 / 0.7) < 4 * (n * 0.25) ** 0.5
    df.unpersist()


def test_same_seed_same_rows_other_partitions(spark, demo):
    seeds = ex.class_seeds(spark, ["simple", "agentic"], 100)
    first = ex.expand_rows(seeds.repartition(7), demo, 3)
    second = ex.expand_rows(seeds.coalesce(1), demo, 3)
    assert rows(first) == rows(second)
    assert rows(first) != rows(ex.expand_rows(seeds, demo, 4))


def test_expansion_does_not_shuffle(spark, demo):
    shown = plan(ex.expand_rows(ex.class_seeds(spark, ["simple"], 10), demo, 3)).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning" not in shown and "Cartesian" not in shown and "NestedLoop" not in shown
    assert "Python" not in shown


def test_large_catalogue_joins_instead_of_broadcasting(spark, monkeypatch):
    from labelloom.operators import scale

    want = rows(ex.expand_rows(ex.class_seeds(spark, ["simple"], 50), cl.catalog_from_dict(spark, DEMO, LANGUAGES), 3))
    monkeypatch.setattr(scale.checked_broadcast, "__defaults__", (1,))
    got = rows(ex.expand_rows(ex.class_seeds(spark, ["simple"], 50), cl.catalog_from_dict(spark, DEMO, LANGUAGES), 3))
    assert got == want


def test_validation(spark):
    raw = spark.createDataFrame([("c", json.dumps({"classes": {"a": {"templates": {"en": {}}}}}))], "catalog_id string, body string")
    errors = {r["error"] for r in cl.validate_catalog(raw, ["a", "b"]).collect()}
    assert "missing class: b" in errors and "missing top-level key: noise_patterns" in errors
    assert "a.templates: missing language 'ko'" in errors and "a.templates.en: missing register 'casual'" in errors
    assert not any("templates.ko" in e for e in errors)
    assert "a: missing key 'slot_lists'" in errors


def test_long_abbreviation_list_is_joined(spark, monkeypatch):
    """20,000 abbreviations: no literal; and the join gives the rows of the literal."""
    world = {**DEMO, "noise_patterns": {**DEMO["noise_patterns"]}}
    data = spark.range(400).selectExpr(
        "id AS record_id", "concat_ws(' ', transform(sequence(1, 40), i -> 'W' || (id * 7 + i) % 300)) AS text", "'simple' AS label", "'en' AS lang"
    )
    data = data.unionAll(data.limit(5))
    short = {f"w{i}": [f"a{i}", f"b{i}"] for i in range(250)} | {"w299": []}
    world["noise_patterns"]["abbreviations"] = short
    want = rows(ex.augment(data, cl.catalog_from_dict(spark, world, LANGUAGES), 3, transform=False))
    monkeypatch.setattr(cl, "MAP_ABBREVIATIONS", 10)
    assert rows(ex.augment(data, cl.catalog_from_dict(spark, world, LANGUAGES), 3, transform=False)) == want
    assert any("a1" in r or "b1" in r for t in want for r in str(t).split())
    monkeypatch.undo()
    world["noise_patterns"]["abbreviations"] = short | {f"other{i}": ["x"] for i in range(20_000)}
    assert rows(ex.augment(data, cl.catalog_from_dict(spark, world, LANGUAGES), 3, transform=False)) == want

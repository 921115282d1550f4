"""Template catalogue: one JSON document flattened to tables.

Every list entry becomes a row with its position, so a uniform pick is an equi join on
(label, lang, pos). The joins need no arrays and no size limit; small tables are
broadcast after a size check.
"""

from __future__ import annotations

import json
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators.scale import checked_broadcast

RAW = "map<string,string>"
LISTS = "map<string,array<string>>"


def _object(col: Column) -> Column:
    """JSON object as MAP of raw JSON values, in file order; empty for a missing object."""
    return F.coalesce(F.from_json(col, RAW), F.from_json(F.lit("{}"), RAW))


def _list(col: Column) -> Column:
    """JSON array of strings; NULL for anything else."""
    return F.when(F.startswith(F.ltrim(col), F.lit("[")), F.from_json(col, "array<string>"))


def _size(col: Column) -> Column:
    return F.greatest(F.coalesce(F.size(col), F.lit(0)), F.lit(0))


MAP_ABBREVIATIONS = 1_000  # up to so many are a literal in the plan; more are joined


class Catalog:
    """The tables of one catalogue, each computed on first use and then kept.

    ``classes`` has one row per label: languages with cumulative weights, the other labels.
    ``dims`` has one row per (label, lang): pool sizes and slot lists. ``templates``,
    ``situations``, ``wrappers``, ``bridges`` and ``fillers`` hold one text per row with its
    position; ``slots``, ``signals`` and ``abbreviations`` the remaining lists.
    """

    def __init__(self, raw: DataFrame, tables: dict[str, DataFrame]):
        self.raw = raw
        self._tables = tables
        self._kept: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(name)
        if name not in self._kept:
            self._kept[name] = checked_broadcast(tables[name])
        return self._kept[name]

    @cached_property
    def abbreviation_map(self) -> Column | None:
        """MAP<STRING, ARRAY<STRING>> literal of a short abbreviation list, None when it is empty or long."""
        rows = self._tables["abbreviations"].limit(MAP_ABBREVIATIONS + 1).collect()
        if len(rows) > MAP_ABBREVIATIONS:
            return None
        pairs = [x for r in rows if r["alternatives"] for x in (F.lit(r["word"]), F.lit(list(r["alternatives"])))]
        return F.create_map(*pairs) if pairs else None

    @cached_property
    def has_abbreviations(self) -> bool:
        return not self._tables["abbreviations"].filter("alternatives IS NOT NULL").isEmpty()


def read_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``catalog_id`` (the path) and ``body`` (the JSON text)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("catalog_id"), F.col("value").alias("body")
    )


def load_catalog(spark: SparkSession, path: str, languages: list[str] | None = None) -> Catalog:
    return build_catalog(read_catalogs(spark, path), languages)


def catalog_from_dict(spark: SparkSession, world: dict, languages: list[str] | None = None) -> Catalog:
    body = json.dumps(world, ensure_ascii=False)
    return build_catalog(spark.createDataFrame([("literal", body)], "catalog_id string, body string"), languages)


def _class_rows(raw: DataFrame) -> DataFrame:
    """One row per class of a catalogue: ``idx``, ``label``, ``top`` and ``cls`` maps of raw JSON."""
    return (
        raw.select("catalog_id", _object(F.col("body")).alias("top"))
        .select("catalog_id", "top", F.posexplode(_object(F.col("top")["classes"])).alias("idx", "label", "cls"))
        .withColumn("cls", _object(F.col("cls")))
    )


def _flat(registers: Column) -> Column:
    """Templates of one language in file order: ARRAY<STRUCT<register, text>>."""

    def pool(entry: Column) -> Column:
        texts = F.coalesce(_list(entry["value"]), F.array().cast("array<string>"))
        return F.transform(texts, lambda t: F.struct(entry["key"].alias("register"), t.alias("text")))

    return F.flatten(F.transform(F.map_entries(_object(registers)), pool))


def _lang_rows(classes: DataFrame) -> DataFrame:
    """One row per class and template language, with ``flat``."""
    return classes.select("*", F.explode(_object(F.col("cls")["templates"])).alias("lang", "registers")).withColumn(
        "flat", _flat(F.col("registers"))
    )


def _pool(by_lang: DataFrame, keys: list[str]) -> DataFrame:
    return by_lang.select(*keys, F.posexplode(_list(F.col("list"))).alias("pos", "text"))


def build_catalog(raw: DataFrame, languages: list[str] | None = None) -> Catalog:
    """Flatten one catalogue. Everything is computed inside its row: no joins, no shuffles."""
    languages = list(languages or ["en"])
    candidates = languages + [fv.MIXED_LANG] * (fv.MIXED_LANG not in languages)
    class_rows = _class_rows(raw)
    lang_rows = _lang_rows(class_rows)
    top, cls = F.col("top"), F.col("cls")
    noise = _object(top["noise_patterns"])

    weight = F.create_map(
        *[x for c in candidates for x in (F.lit(c), F.lit(fv.LANG_WEIGHTS.get(c, fv.OTHER_LANG_WEIGHT)))]
    )
    in_order = F.array(*[F.lit(c) for c in candidates])
    langs = F.filter(in_order, lambda c: F.size(_flat(F.element_at(_object(cls["templates"]), c))) > 0)
    classes = class_rows.select(
        "label",
        "idx",
        langs.alias("langs"),
        F.size(F.map_keys(_object(top["classes"]))).alias("n_classes"),
        F.lit(languages[0]).alias("first_lang"),
    ).withColumn(
        "edges",
        F.transform(
            "langs",
            lambda _, i: F.aggregate(
                F.slice("langs", F.lit(1), i + 1), F.lit(0.0), lambda acc, c: acc + F.element_at(weight, c)
            ),
        ),
    )

    def names(col: Column) -> Column:
        return F.map_keys(_object(col))

    def count_of(name: str) -> Column:
        return F.size(F.filter("registers", lambda r: r == F.lit(name)))

    pools = {
        "n_situations": cls["situation_corpus"],
        "n_wrappers": cls["conversational_wrappers"],
        "n_bridges": top["compound_bridges"],
        "n_fillers": noise["filler_words"],
    }
    every_lang = F.array_union(in_order, names(cls["templates"]))
    for source in pools.values():
        every_lang = F.array_union(every_lang, names(source))
    dims = (
        class_rows.withColumn("lang", F.explode(every_lang))
        .withColumn(
            "registers",
            F.transform(_flat(F.element_at(_object(cls["templates"]), F.col("lang"))), lambda t: t["register"]),
        )
        .select(
            "label",
            "lang",
            F.size("registers").alias("n_any"),
            *[
                expr
                for name in ("fragment", "implicit")
                for expr in (
                    (F.array_position("registers", name).cast("int") - 1).alias(name + "_at"),
                    count_of(name).alias("n_" + name),
                )
            ],
            *[
                _size(_list(F.element_at(_object(source), F.col("lang")))).alias(name)
                for name, source in pools.items()
            ],
            F.transform_values(_object(cls["slot_lists"]), lambda _, v: _list(v)).alias("slots"),
        )
    )

    def class_lists(key: str) -> DataFrame:
        return class_rows.select("label", F.explode(_object(cls[key])).alias("lang", "list"))

    one = raw.select(_object(F.col("body")).alias("top"))
    tables = {
        "classes": classes,
        "dims": dims,
        "templates": lang_rows.select("label", "lang", F.posexplode("flat").alias("pos", "t")).select(
            "label", "lang", F.col("t.register").alias("register"), "pos", F.col("t.text").alias("text")
        ),
        "slots": class_rows.select("label", F.explode(_object(cls["slot_lists"])).alias("slot", "list")).select(
            "label", "slot", _list(F.col("list")).alias("values")
        ),
        "situations": _pool(class_lists("situation_corpus"), ["label", "lang"]),
        "wrappers": _pool(class_lists("conversational_wrappers"), ["label", "lang"]),
        "signals": class_rows.select(
            F.col("label").alias("label_b"),
            F.explode(_object(cls["cross_class_discriminators"])).alias("versus", "body"),
        )
        .filter(F.startswith("versus", F.lit("vs_")))
        .select(
            "label_b",
            F.substr("versus", F.lit(4)).alias("label_a"),
            F.explode(_list(_object(F.col("body"))["key_signals"])).alias("signal"),
        ),
        "bridges": _pool(one.select(F.explode(_object(top["compound_bridges"])).alias("lang", "list")), ["lang"]),
        "filler_counts": one.select(F.explode(_object(noise["filler_words"])).alias("lang", "list")).select(
            "lang", _size(_list(F.col("list"))).alias("n_fillers")
        ),
        "fillers": _pool(one.select(F.explode(_object(noise["filler_words"])).alias("lang", "list")), ["lang"]),
        "abbreviations": one.select(F.explode(_object(noise["abbreviations"])).alias("word", "list")).select(
            "word", _list(F.col("list")).alias("alternatives")
        ),
    }
    return Catalog(raw, tables)


# --- summary and validation -------------------------------------------------------------


def catalog_summary(raw: DataFrame) -> DataFrame:
    """Per catalogue: templates per class and language, slot entries per class, bridges per language.

    The standard languages are always listed, with 0 where a catalogue has nothing.
    """
    standard = F.array(*[F.lit(x) for x in fv.CATALOG_LANGS])
    top, cls, lang = F.col("top"), F.col("cls"), F.col("lang")
    class_rows = _class_rows(raw)
    templates = class_rows.withColumn(
        "lang", F.explode(F.array_union(standard, F.map_keys(_object(cls["templates"]))))
    ).select(
        "catalog_id", F.lit("templates").alias("kind"), "label", "lang",
        F.size(_flat(F.element_at(_object(cls["templates"]), lang))).alias("n"),
    )
    entries = F.aggregate(
        F.map_values(_object(cls["slot_lists"])), F.lit(0), lambda acc, values: acc + _size(_list(values))
    )
    slots = class_rows.select(
        "catalog_id", F.lit("slot_entries").alias("kind"), "label", F.lit("").alias("lang"), entries.alias("n")
    )
    bridges = (
        raw.select("catalog_id", _object(_object(F.col("body"))["compound_bridges"]).alias("top"))
        .withColumn("lang", F.explode(F.array_union(standard, F.map_keys(top))))
        .select(
            "catalog_id", F.lit("bridges").alias("kind"), F.lit("").alias("label"), "lang",
            _size(_list(F.element_at(top, lang))).alias("n"),
        )
    )
    return templates.unionByName(slots).unionByName(bridges).withColumn("n", F.col("n").cast("bigint"))


def validate_catalog(raw: DataFrame, classes: list[str]) -> DataFrame:
    """One row per structural error: ``catalog_id``, ``error``.

    A missing class hides the errors inside it; a missing language hides its registers.
    """

    def literals(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def absent(wanted: list[str], have: Column) -> Column:
        return F.filter(literals(wanted), lambda name: ~F.array_contains(F.map_keys(have), name))

    def messages(names: Column, before, after: str = "") -> Column:
        return F.transform(names, lambda n: F.concat(before, n, F.lit(after)))

    def class_errors(name: Column, all_classes: Column) -> Column:
        cls = _object(F.element_at(all_classes, name))
        langs = _object(cls["templates"])
        gone = absent(fv.CATALOG_LANGS, langs)
        prefix = F.concat(name, F.lit(".templates"))
        registers = F.flatten(
            F.transform(
                F.array_except(literals(fv.CATALOG_LANGS), gone),
                lambda lang: messages(
                    absent(fv.REGISTERS, _object(F.element_at(langs, lang))),
                    F.concat(prefix, F.lit("."), lang, F.lit(": missing register '")),
                    "'",
                ),
            )
        )
        return F.concat(
            messages(absent(fv.CLASS_KEYS, cls), F.concat(name, F.lit(": missing key '")), "'"),
            messages(gone, F.concat(prefix, F.lit(": missing language '")), "'"),
            registers,
        )

    parsed = raw.select("catalog_id", _object(F.col("body")).alias("top")).withColumn(
        "all_classes", _object(F.col("top")["classes"])
    )
    have = F.col("all_classes")
    missing = absent(classes, have)
    inside = F.flatten(
        F.transform(F.array_except(literals(classes), missing), lambda name: class_errors(name, have))
    )
    errors = F.concat(
        messages(absent(fv.CATALOG_KEYS, F.col("top")), F.lit("missing top-level key: ")),
        messages(missing, F.lit("missing class: ")),
        inside,
    )
    return parsed.select("catalog_id", F.explode(errors).alias("error"))

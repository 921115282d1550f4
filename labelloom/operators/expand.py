"""Dataset expansion: one row per seed row, composed from a template catalogue.

Every choice is a seeded draw on the row key, so the plan is a chain of lookups and
projections over the seed rows: no shuffle while the catalogue is small enough to
broadcast, ordinary equi joins on (label, lang, pos) when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.draws import draw, pick, pick_index, pick_literal, pick_weighted, unit
from ..functions.text import (
    abbreviate,
    add_suffix,
    fill_slots,
    filler_insert,
    filler_prefix,
    first_words,
    let,
    replace_marker,
    to_formal,
    to_passive,
    to_question,
    typo,
    words,
)
from ..sources.catalog import Catalog
from .datasets import shuffle

KEY = "record_id"


def class_seeds(spark: SparkSession, labels: list[str], n_per_class: int) -> DataFrame:
    """``n_per_class`` rows for every class: ``record_id``, ``label``."""
    names = F.array(*[F.lit(x) for x in labels])
    rows = spark.range(len(labels) * n_per_class).withColumnRenamed("id", KEY)
    return rows.withColumn("label", F.element_at(names, (F.floor(F.col(KEY) / n_per_class) + 1).cast("int")))


def _lookup(df: DataFrame, table: DataFrame, on: dict[str, str], **out: str) -> DataFrame:
    """Left equi join of ``df`` on {column of df: column of table}; adds the ``out`` columns."""
    keys = {right: "__r_" + right for right in on.values()}
    side = table.select(*[F.col(k).alias(v) for k, v in keys.items()], *[F.col(c).alias(n) for n, c in out.items()])
    cond = None
    for left, right in on.items():
        term = F.col(left) == F.col(keys[right])
        cond = term if cond is None else cond & term
    return df.join(side, cond, "left").drop(*keys.values())


def with_language(df: DataFrame, catalog: Catalog, seed: int = 42) -> DataFrame:
    """Add ``lang``: weighted pick among the languages the class has templates for."""
    joined = _lookup(
        df, catalog.classes, {"label": "label"},
        __langs="langs", __edges="edges", __first="first_lang", __idx="idx", __n_classes="n_classes",
    )
    x = unit(seed, F.col(KEY), "lang") * F.element_at("__edges", -1)
    place = let(x, lambda at: F.size(F.filter("__edges", lambda edge: edge <= at)))
    lang = F.coalesce(F.get("__langs", place), F.col("__first"))
    return joined.withColumn("lang", F.when(F.size("__langs") > 0, lang).otherwise(F.col("__first"))).drop(
        "__langs", "__edges", "__first"
    )


def with_conv_type(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.withColumn("conv_type", pick_weighted(fv.CONV_TYPES, unit(seed, F.col(KEY), "conv_type")))


def with_pools(df: DataFrame, catalog: Catalog) -> DataFrame:
    sizes = {
        "n_any": "n_any", "fragment_at": "fragment_at", "n_fragment": "n_fragment",
        "implicit_at": "implicit_at", "n_implicit": "n_implicit", "n_situations": "n_situations",
        "n_wrappers": "n_wrappers", "n_bridges": "n_bridges", "n_fillers": "n_fillers",
        "slots": "slots",
    }
    return _lookup(
        df, catalog.dims, {"label": "label", "lang": "lang"}, **{"__" + k: v for k, v in sizes.items()}
    )


def with_base_text(df: DataFrame, catalog: Catalog, seed: int = 42) -> DataFrame:
    """Add ``text`` and ``register`` for the conversation type of each row."""
    key, kind = F.col(KEY), F.col("conv_type")

    def number(name: str) -> Column:
        return draw(seed, key, name)

    template = number("template")
    position = (
        F.when(
            (kind == "D") & (F.col("__n_fragment") > 0),
            F.col("__fragment_at") + pick_index(template, F.col("__n_fragment")),
        )
        .when(
            (kind == "F") & (F.col("__n_implicit") > 0),
            F.col("__implicit_at") + pick_index(template, F.col("__n_implicit")),
        )
        .otherwise(pick_index(template, F.col("__n_any")))
    )
    uses_situation = kind.isin("B", "D") | (
        (kind == "F") & (unit(seed, key, "situation_use") < F.lit(fv.SITUATION_PROB))
    )
    df = df.withColumns(
        {
            "__pos": position,
            "__sit_pos": F.when(uses_situation, pick_index(number("situation"), F.col("__n_situations"))),
            "__wrap_pos": F.when(kind == "C", pick_index(number("wrapper"), F.col("__n_wrappers"))),
            "__bridge_pos": F.when(kind == "E", pick_index(number("bridge"), F.col("__n_bridges"))),
            "__other": F.when(kind == "E", pick_index(number("second"), F.col("__n_classes") - 1)),
        }
    )
    # the classes without the own one, counted in their order
    df = df.withColumn("__second_idx", F.col("__other") + (F.col("__other") >= F.col("__idx")).cast("int"))
    df = _lookup(df, catalog.classes, {"__second_idx": "idx"}, __second="label")
    own = {"label": "label", "lang": "lang"}
    df = _lookup(df, catalog.templates, {**own, "__pos": "pos"}, __template="text", __register="register")
    df = _lookup(df, catalog.situations, {**own, "__sit_pos": "pos"}, __situation="text")
    df = _lookup(df, catalog.wrappers, {**own, "__wrap_pos": "pos"}, __wrapper="text")
    df = _lookup(df, catalog.bridges, {"lang": "lang", "__bridge_pos": "pos"}, __bridge="text")
    second = {"__second": "label", "lang": "lang"}
    df = _lookup(df, catalog.dims, second, __second_any="n_any", __second_slots="slots")
    df = df.withColumn("__second_pos", pick_index(number("second_template"), F.col("__second_any")))
    df = _lookup(df, catalog.templates, {**second, "__second_pos": "pos"}, __second_template="text")

    filled = fill_slots(F.coalesce("__template", F.lit("")), F.col("__slots"), seed, key)
    df = df.withColumn("__filled", filled)
    plain, situation, wrapper, bridge = (F.col(c) for c in ("__filled", "__situation", "__wrapper", "__bridge"))
    register = F.coalesce("__register", F.lit("unknown"))

    with_situation = F.concat(situation, pick_literal(fv.CONNECTORS, number("connector")), plain)
    wrapped = F.when(
        F.contains(wrapper, F.lit("[INTENT]")), replace_marker(wrapper, "[INTENT]", plain)
    ).otherwise(F.concat(wrapper, F.lit(", "), plain))
    first = F.when(F.col("__template").isNull(), F.col("label")).otherwise(plain)
    other = fill_slots(
        F.coalesce("__second_template", "__second", "label"), F.col("__second_slots"), seed, key, "second_slot"
    )
    both = F.contains(bridge, F.lit("[INTENT_A]")) & F.contains(bridge, F.lit("[INTENT_B]"))
    compound = F.when(
        both, replace_marker(replace_marker(bridge, "[INTENT_A]", first), "[INTENT_B]", other)
    ).otherwise(F.concat_ws(" ", first, bridge, other))

    def after(words: int) -> Column:
        return F.concat(first_words(situation, words), F.lit(fv.DASH), plain)

    text = (
        F.when((kind == "B") & situation.isNotNull(), with_situation)
        .when((kind == "C") & wrapper.isNotNull(), wrapped)
        .when((kind == "D") & situation.isNotNull(), after(fv.FRAGMENT_SITUATION_WORDS))
        .when((kind == "E") & bridge.isNotNull(), compound)
        .when((kind == "F") & situation.isNotNull(), after(fv.IMPLICIT_SITUATION_WORDS))
        .otherwise(plain)
    )
    name = (
        F.when(kind == "D", F.when(plain == "", "unknown").otherwise("fragment"))
        .when((kind == "E") & bridge.isNotNull(), "compound")
        .when(kind == "F", "implicit")
        .otherwise(register)
    )
    return df.withColumns({"text": text, "register": name})


def _with_filler(df: DataFrame, catalog: Catalog, seed: int, name: str) -> DataFrame:
    """Add ``__filler``: a filler word of the row's language, NULL when it has none."""
    at = pick_index(draw(seed, F.col(KEY), name), F.col("__n_fillers"))
    return _lookup(
        df.withColumn("__filler_pos", at), catalog.fillers, {"lang": "lang", "__filler_pos": "pos"}, __filler="text"
    ).drop("__filler_pos")


def with_transform(
    df: DataFrame, catalog: Catalog, seed: int = 42, when: Column | None = None
) -> DataFrame:
    """Rewrite the text of the chosen rows: question, passive, suffix, formal or filler prefix."""
    key, text = F.col(KEY), F.col("text")
    df = _with_filler(df, catalog, seed, "prefix_filler")
    ways = F.lit(4) + (F.coalesce("__n_fillers", F.lit(0)) > 0).cast("int")
    way = pick_index(draw(seed, key, "transform"), ways)
    rewritten = (
        F.when(way == 0, to_question(text, seed, key))
        .when(way == 1, to_passive(text, seed, key))
        .when(way == 2, add_suffix(text, seed, key))
        .when(way == 3, to_formal(text, seed, key))
        .otherwise(filler_prefix(text, F.col("__filler")))
    )
    chosen = unit(seed, key, "transform_use") < F.lit(fv.TRANSFORM_PROB)
    chosen = chosen & when if when is not None else chosen
    return df.withColumn("text", F.when(chosen, rewritten).otherwise(text)).drop("__filler")


def with_noise(df: DataFrame, catalog: Catalog, seed: int = 42) -> DataFrame:
    """Add ``noised``; noisy rows get a typo, abbreviations or a filler word."""
    key, text = F.col(KEY), F.col("text")
    df = _with_filler(df, catalog, seed, "noise_filler")
    abbreviations = catalog.abbreviation_map
    joined = abbreviations is None and catalog.has_abbreviations
    has_filler = F.coalesce("__n_fillers", F.lit(0)) > 0
    ways = F.lit(2 if joined or abbreviations is not None else 1) + has_filler.cast("int")
    way = pick_index(draw(seed, key, "noise"), ways)
    noisy = F.when(way == 0, typo(text, seed, key))
    if abbreviations is not None:
        noisy = noisy.when(way == 1, abbreviate(text, abbreviations, seed, key))
    if joined:
        chosen = (way == 1) & (unit(seed, key, "noise_use") < F.lit(fv.NOISE_PROB))
        df = _with_abbreviated(df, catalog.abbreviations, chosen, seed)
        noisy = noisy.when(way == 1, F.coalesce("__short", text))
    noisy = noisy.otherwise(filler_insert(text, F.col("__filler"), seed, key))
    df = df.withColumn("noised", unit(seed, key, "noise_use") < F.lit(fv.NOISE_PROB))
    return df.withColumn("text", F.when(F.col("noised"), noisy).otherwise(text)).drop("__filler", *["__short"] * joined)


def _with_abbreviated(df: DataFrame, table: DataFrame, chosen: Column, seed: int) -> DataFrame:
    """Add ``__short``: the text of the chosen rows with abbreviations, by a join on the lower-cased word.

    Only words that are drawn for replacement are joined; equal (record, text) rows are looked up once.
    """
    key = F.col(KEY)
    drawn = df.filter(chosen).select(KEY, "text").distinct()
    each = drawn.select(KEY, "text", F.posexplode(words(F.col("text"))).alias("i", "word"))
    index = F.col("i").cast("string")
    hit = unit(seed, key, F.concat(F.lit("abbr#"), index)) < F.lit(fv.ABBREVIATE_PROB)
    number = draw(seed, key, F.concat(F.lit("abbr_pick#"), index))
    other = table.select(F.col("word").alias("__word"), "alternatives")
    found = each.filter(hit).join(other, F.lower("word") == F.col("__word"))
    found = found.withColumn("new", pick(F.col("alternatives"), number)).filter(F.col("new").isNotNull())
    changes = found.groupBy(KEY, "text").agg(F.map_from_entries(F.collect_list(F.struct("i", "new"))).alias("changes"))
    replaced = F.transform(
        words(F.col("text")), lambda w, i: F.coalesce(F.try_element_at(F.col("changes"), i.cast("int")), w)
    )
    short = drawn.join(changes, [KEY, "text"], "left").select(
        F.col(KEY).alias("__k"), F.col("text").alias("__t"),
        F.array_join(F.when(F.col("changes").isNull(), words(F.col("text"))).otherwise(replaced), " ").alias("__short"),
    )
    return df.join(short, (key == F.col("__k")) & (F.col("text") == F.col("__t")), "left").drop("__k", "__t")


def _finish(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def expand_rows(
    seeds: DataFrame, catalog: Catalog, seed: int = 42, conv_type: str | None = None, rewrite: bool = True
) -> DataFrame:
    """One expanded record per seed row (``record_id``, ``label``).

    ``conv_type`` fixes the conversation type; ``rewrite=False`` leaves out transforms and noise.
    """
    df = with_language(seeds, catalog, seed)
    df = df.withColumn("conv_type", F.lit(conv_type)) if conv_type else with_conv_type(df, seed)
    df = with_base_text(with_pools(df, catalog), catalog, seed)
    if rewrite:
        df = with_transform(df, catalog, seed, F.col("conv_type").isin(*fv.TRANSFORMED_TYPES))
        df = with_noise(df, catalog, seed)
    else:
        df = df.withColumn("noised", F.lit(False))
    return _finish(df)


def expand(spark: SparkSession, catalog: Catalog, labels: list[str], n_per_class: int, seed: int = 42) -> DataFrame:
    """``n_per_class`` records for each class, in seeded order."""
    return shuffle(expand_rows(class_seeds(spark, labels, n_per_class), catalog, seed), seed)


def augment(
    df: DataFrame, catalog: Catalog, seed: int = 42, transform: bool = True, noise: bool = True
) -> DataFrame:
    """Transforms and noise for a table of (``record_id``, ``text``, ``label``, ``lang``, ...)."""
    out = _lookup(df, catalog.filler_counts, {"lang": "lang"}, __n_fillers="n_fillers")
    if transform:
        out = with_transform(out, catalog, seed)
    if noise:
        out = with_noise(out, catalog, seed)
    return _finish(out)

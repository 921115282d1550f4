"""Labelled tables: projections, joins, splits, samples, unions and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import draw
from ..functions.text import strip
from .digests import not_among
from .scale import DRAW_SPAN, checked_broadcast, cutoffs, row_hash, seeded_order, within_cutoff

CLASSES_SCHEMA = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)


def classes_table(spark: SparkSession, classes: list[str] | dict[str, str]) -> DataFrame:
    """Class dimension; the order of the classes is their index."""
    described = classes if isinstance(classes, dict) else dict.fromkeys(classes)
    rows = [(label, i, text) for i, (label, text) in enumerate(described.items())]
    return spark.createDataFrame(rows, CLASSES_SCHEMA)


# --- projections and filters -----------------------------------------------------


def with_text(df: DataFrame, new_text: Column) -> DataFrame:
    """Replace the text, keep it as ``original_text``, keep every other column."""
    return df.withColumns({"original_text": F.col("text"), "text": new_text})


def non_blank(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(strip(F.col(col)) != "")


def with_correct(df: DataFrame) -> DataFrame:
    return df.withColumn("correct", (F.col("pred") == F.col("label")).cast("int"))


def with_record_id(df: DataFrame, col: str = "record_id") -> DataFrame:
    """Add a key made of the row's own content, for tables without one; equal rows share it."""
    return df.withColumn(col, F.md5(F.to_json(F.struct(*df.columns))))


def _known_id() -> Column:
    """``record_id``; a NULL is an error, because every seeded choice depends on it."""
    missing = F.raise_error(F.lit("record_id is NULL: see with_record_id"))
    return F.when(F.col("record_id").isNull(), missing.cast("string")).otherwise(F.col("record_id").cast("string"))


# --- joins -------------------------------------------------------------------------


def pending(samples: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose text is not among the finished ``original_text``; texts are compared by 128-bit digests and are not shuffled."""
    return not_among(samples, "text", done, "original_text")


def class_deficit(
    records: DataFrame, classes: DataFrame, n: int | Column, keys: list[str] | None = None
) -> DataFrame:
    """Rows each class still needs to reach ``n``; full classes are left out.

    ``classes`` holds one row per class (and per task, when ``keys`` says so).
    """
    keys = keys or ["label"]
    have = records.filter(F.col("label").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
    target = n if isinstance(n, Column) else F.lit(n)
    counted = classes.join(have, keys, "left").withColumn("have", F.coalesce("have", F.lit(0).cast("bigint")))
    return counted.withColumn("need", target.cast("bigint") - F.col("have")).filter(F.col("need") > 0)


def attach_predictions(records: DataFrame, preds: DataFrame) -> DataFrame:
    """Add ``pred`` by ``record_id``; a record with no prediction, or with several, is an error."""
    several = F.raise_error(F.concat(F.lit("several predictions for record "), F.col("record_id").cast("string")))
    single = preds.groupBy("record_id").agg(F.first("pred").alias("pred"), F.count(F.lit(1)).alias("__n"))
    single = single.select("record_id", F.when(F.col("__n") > 1, several.cast("string")).otherwise(F.col("pred")).alias("pred"))
    joined = records.join(single, "record_id", "left")
    missing = F.raise_error(F.concat(F.lit("no prediction for record "), F.col("record_id").cast("string")))
    return joined.withColumn("pred", F.when(F.col("pred").isNull(), missing).otherwise(F.col("pred")))


def encode_labels(df: DataFrame, classes: DataFrame, on_unknown: str = "raise") -> DataFrame:
    """Add ``label_idx``. ``on_unknown``: ``raise`` at run time, or ``drop`` (see quarantine)."""
    dim = classes.select("label", F.col("idx").alias("label_idx"))
    if on_unknown == "drop":
        return df.join(checked_broadcast(dim), "label", "inner")
    if on_unknown != "raise":
        raise ValueError(f"on_unknown: {on_unknown}")
    joined = df.join(checked_broadcast(dim), "label", "left")
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce("label", F.lit("NULL")))).cast("int")
    return joined.withColumn(
        "label_idx", F.when(F.col("label_idx").isNull(), unknown).otherwise(F.col("label_idx"))
    )


def quarantine_labels(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows whose label is not a class."""
    return df.join(checked_broadcast(classes.select("label")), "label", "left_anti")


def remap_labels(df: DataFrame, label_map: DataFrame, col: str = "label") -> DataFrame:
    """Mapped label where ``label_map(from_label, to_label)`` has one, else unchanged."""
    mapping = checked_broadcast(label_map.select("from_label", "to_label"))
    joined = df.join(mapping, df[col] == mapping["from_label"], "left")
    return joined.withColumn(col, F.coalesce("to_label", col)).drop("from_label", "to_label")


# --- split, sample, cap, shuffle --------------------------------------------------------


def stratified_split(
    df: DataFrame, ratio: float = 0.2, seed: int = 42, group_col: str | None = None
) -> DataFrame:
    """Add ``split``: per label, ``max(1, floor(n * ratio))`` rows go to ``val``.

    With ``group_col`` (such as ``original_text``) all rows of one group share a split:
    the groups of a label are split instead of its rows.
    """

    def val_rows(n: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(n * F.lit(float(ratio))))

    if group_col:
        unit = F.md5(F.coalesce(F.col(group_col), F.col("text")))
        marked = df.withColumn("__unit", unit)
        units = marked.groupBy("label", "__unit").agg(F.count(F.lit(1)).alias("__rows"))
        number = draw(seed, F.col("__unit"), "split")
        order = [number, F.col("__unit")]  # units are distinct
        cuts = cutoffs(units, ["label"], order, quota=val_rows, span=DRAW_SPAN)
        chosen = within_cutoff(marked, cuts, ["label"], order, "__val").drop("__unit")
    else:
        order = [draw(seed, _known_id(), "split"), F.col("record_id"), row_hash(df)]
        cuts = cutoffs(df, ["label"], order, quota=val_rows, span=DRAW_SPAN)
        chosen = within_cutoff(df, cuts, ["label"], order, "__val")
    return chosen.withColumn("split", F.when(F.col("__val"), "val").otherwise("train")).drop("__val")


def sample_quotas(df: DataFrame, n: int) -> DataFrame:
    """``n div k`` rows per label; the first ``n mod k`` labels in order get one more."""
    labels = df.groupBy("label").agg(F.count(F.lit(1)).alias("have"))
    # one row per class from here on
    numbered = labels.withColumns(
        {
            "position": F.row_number().over(Window.orderBy("label")) - 1,
            "k": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )
    base = F.floor(F.lit(n) / F.col("k"))
    extra = F.when(F.col("position") < F.lit(n) % F.col("k"), 1).otherwise(0)
    return numbered.select("label", "have", (base + extra).cast("bigint").alias("quota"))


def stratified_sample(df: DataFrame, n: int, seed: int = 99) -> DataFrame:
    """Seeded sample of ``n`` rows over the labels; short labels are not refilled."""
    order = [draw(seed, _known_id(), "sample"), F.col("record_id"), row_hash(df)]
    quotas = sample_quotas(df, n).select("label", "quota")
    cuts = cutoffs(df, ["label"], order, quotas=quotas, span=DRAW_SPAN)
    return within_cutoff(df, cuts, ["label"], order, "__in").filter("__in").drop("__in")


def cap_per_class(
    df: DataFrame, need: DataFrame, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """First ``need`` rows of each class in ``order``; the first order column is an integer.

    ``need`` has the key columns and ``need``; classes without a row there get nothing.
    """
    keys = keys or ["label"]
    order = order or ["line_no"]
    columns = [*[F.col(c) for c in order], row_hash(df)]
    quotas = need.select(*keys, F.col("need").alias("quota"))
    cuts = cutoffs(df, keys, columns, quotas=quotas)
    return within_cutoff(df, cuts, keys, columns, "__in").filter("__in").drop("__in")


def shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """Seeded order of the whole table (range partitioned, then sorted)."""
    _, order = seeded_order(seed, "record_id")
    return df.orderBy(*order)


def with_shuffle_position(df: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``shuffle_pos`` (0-based): each row's place in the seeded order.

    Rows are ranked inside 65,536 buckets of the draw; the bucket totals, at most
    65,536 rows, give each bucket its offset.
    """
    bucket, order = seeded_order(seed, "record_id")
    marked = df.withColumn("__bucket", bucket)
    sizes = marked.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    running = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__bucket", F.coalesce(F.sum("__size").over(running), F.lit(0)).alias("__offset")
    )
    ranked = marked.join(F.broadcast(offsets), "__bucket")
    inside = Window.partitionBy("__bucket").orderBy(*order)
    return ranked.withColumn(
        "shuffle_pos", (F.row_number().over(inside) - 1 + F.col("__offset")).cast("bigint")
    ).drop("__bucket", "__offset")


# --- set operations ------------------------------------------------------------------


def merge(*dfs: DataFrame) -> DataFrame:
    """Bag union by name; missing columns become NULL, nothing is deduplicated."""
    out = dfs[0]
    for other in dfs[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def languages(df: DataFrame) -> DataFrame:
    return df.select("lang").distinct().orderBy("lang")


# --- summaries -----------------------------------------------------------------------


def distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Totals and noised share overall and by label, lang and conv_type, in one pass."""
    cells = df.groupBy("label", "lang", "conv_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("noised").cast("int")).alias("noisy")
    )
    dims = ["label", "lang", "conv_type"]
    level = F.grouping_id()
    grouped = cells.groupingSets([[F.col(d)] for d in dims] + [[]], *dims).agg(
        level.alias("__level"), F.sum("rows").alias("n"), F.coalesce(F.sum("noisy"), F.lit(0)).alias("noised")
    )
    name = (
        F.when(F.col("__level") == 3, "label")
        .when(F.col("__level") == 5, "lang")
        .when(F.col("__level") == 6, "conv_type")
        .otherwise("total")
    )
    return grouped.select(
        name.alias("dimension"),
        F.coalesce(*dims, F.lit("")).alias("value"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.col("noised").cast("bigint").alias("noised"),
        F.coalesce(F.try_divide(F.lit(100.0) * F.col("noised"), F.col("n")), F.lit(0.0)).alias("noised_pct"),
    )

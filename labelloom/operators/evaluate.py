"""Evaluation of scored rows: metrics, robustness axes, latency and gates.

``scored`` rows have ``record_id, text, label, lang, pred``. Axes that only need counts
accept the reduced table of ``scored_cells`` as well (``weight="n"``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import fixed_values as fv
from ..functions.text import argmax, log_sum_exp
from ..session import ensure_checkpoint_dir
from . import stopping
from .datasets import classes_table
from .scale import MAX_BROADCAST_ROWS, checked_broadcast, join_on, local_copy, order_statistics, running_before

BUCKETS = ["short", "medium", "long"]
SIGNAL_ROWS, SIGNAL_BYTES = 50_000, 4_000_000  # signals that are looked up in every row's task
AUTOMATON_BYTES = 2_000_000  # of signals in one automaton (some 100 MB in a task)


def _rows(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1)


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def length_bucket(text: Column) -> Column:
    n = F.length(text)
    return F.when(n <= fv.SHORT_MAX, "short").when(n <= fv.MEDIUM_MAX, "medium").otherwise("long")


def scored_cells(scored: DataFrame) -> DataFrame:
    """Row counts by label, prediction, language and length: one pass over the scored rows."""
    return (
        scored.withColumn("bucket", length_bucket(F.col("text")))
        .groupBy("label", "pred", "lang", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unknown_labels(df: DataFrame, classes: list[str]) -> DataFrame:
    """Rows whose label or prediction is not a class: what the metrics below refuse."""
    known = F.col("label").isin(*classes) & F.col("pred").isin(*classes)
    return df.filter(~F.coalesce(known, F.lit(False)))


def _only_known(df: DataFrame, classes: list[str], on_unknown: str) -> DataFrame:
    """Rows of known labels and predictions; others fail the query, or are left to ``unknown_labels``."""
    known = F.coalesce(F.col("label").isin(*classes) & F.col("pred").isin(*classes), F.lit(False))
    if on_unknown == "drop":
        return df.filter(known)
    if on_unknown != "raise":
        raise ValueError(f"on_unknown: {on_unknown}")
    shown = F.concat_ws(", ", F.lit("unknown label or prediction"), "label", "pred")
    return df.withColumn("label", F.when(known, F.col("label")).otherwise(F.raise_error(shown).cast("string")))


def confusion_matrix(
    df: DataFrame, classes: list[str], weight: str | None = None, on_unknown: str = "raise"
) -> DataFrame:
    """Counts for every (label, pred) of the classes, zero cells included.

    A label or prediction outside the classes fails the query; with ``on_unknown="drop"`` such rows are
    left out here and are the rows of ``unknown_labels``.
    """
    df = _only_known(df, classes, on_unknown)
    counts = df.groupBy("label", "pred").agg(F.sum(_rows(weight)).cast("bigint").alias("n"))
    names = F.array(*[F.lit(c) for c in classes])
    grid = classes_table(df.sparkSession, classes).select("label", F.explode(names).alias("pred"))
    return grid.join(counts, ["label", "pred"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )


def per_class_metrics(
    df: DataFrame, classes: list[str], weight: str | None = None, on_unknown: str = "raise"
) -> DataFrame:
    """Precision, recall, F1 and support of every class; 0.0 where a denominator is 0.

    ``on_unknown`` as in ``confusion_matrix``.
    """
    df = _only_known(df, classes, on_unknown)
    cells = df.groupBy("label", "pred").agg(F.sum(_rows(weight)).alias("n"))
    sides = cells.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col("label").alias("cls"), F.lit("actual").alias("side"), (F.col("label") == F.col("pred")).alias("hit")),
                F.struct(F.col("pred").alias("cls"), F.lit("predicted").alias("side"), F.lit(False).alias("hit")),
            )
        ).alias("s"),
    )

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    sums = sides.groupBy(F.col("s.cls").alias("label")).agg(
        total(F.col("s.side") == "actual").alias("support"),
        total(F.col("s.side") == "predicted").alias("predicted"),
        total(F.col("s.hit")).alias("tp"),
    )
    every = classes_table(df.sparkSession, classes).select("label", "idx").join(sums, "label", "left")
    zero = F.lit(0.0)
    precision = F.coalesce(_share(F.col("tp"), F.col("predicted")), zero)
    recall = F.coalesce(_share(F.col("tp"), F.col("support")), zero)
    every = every.withColumns({"precision": precision, "recall": recall})
    p, r = F.col("precision"), F.col("recall")
    return every.select(
        "label",
        "idx",
        "precision",
        "recall",
        F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), zero).alias("f1"),
        F.coalesce("support", F.lit(0).cast("bigint")).alias("support"),
    )


def _correct(weight: str | None) -> Column:
    return F.sum(F.when(F.col("pred") == F.col("label"), _rows(weight)).otherwise(0))


def accuracy(df: DataFrame, weight: str | None = None) -> DataFrame:
    n = F.coalesce(F.sum(_rows(weight)), F.lit(0)).cast("bigint")
    return df.agg(n.alias("n"), _correct(weight).cast("bigint").alias("correct")).select(
        "n", F.coalesce("correct", F.lit(0).cast("bigint")).alias("correct"),
        _share(F.col("correct"), F.col("n")).alias("accuracy"),
    )


def subset_accuracy(df: DataFrame, cond: Column, weight: str | None = None) -> DataFrame:
    """Accuracy of the rows where ``cond`` holds; NULL for an empty subset."""
    return accuracy(df.filter(cond), weight)


def language_cells(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Accuracy per class and language (long form)."""
    return (
        df.groupBy("label", "lang")
        .agg(_correct(weight).cast("bigint").alias("correct"), F.sum(_rows(weight)).cast("bigint").alias("n"))
        .withColumn("accuracy", _share(F.col("correct"), F.col("n")))
    )


def language_table(df: DataFrame, langs: list[str], weight: str | None = None) -> DataFrame:
    """Accuracy per class, one column per known language."""
    return language_cells(df, weight).groupBy("label").pivot("lang", langs).agg(F.first("accuracy"))


def crosslingual(
    df: DataFrame, gap_pp: float = fv.LANGUAGE_GAP_PP, weight: str | None = None
) -> DataFrame:
    """Per class: largest accuracy gap between languages (percentage points) and the flag."""
    gap = (F.max("accuracy") - F.min("accuracy")) * F.lit(100.0)
    return (
        language_cells(df, weight)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_langs"), F.min("accuracy").alias("min_acc"), F.max("accuracy").alias("max_acc"), gap.alias("gap"))
        .withColumn("flagged", (F.col("n_langs") >= 2) & (F.col("gap") > F.lit(float(gap_pp))))
    )


def codeswitch(
    df: DataFrame, lang: str = fv.MIXED_LANG, max_gap: float = fv.CODESWITCH_GAP_PP, weight: str | None = None
) -> DataFrame:
    """Overall accuracy against the accuracy of code-switched rows; none of those: skipped, passes."""
    mixed = F.col("lang") == F.lit(lang)
    hit = F.col("pred") == F.col("label")
    sums = df.agg(
        F.sum(_rows(weight)).cast("bigint").alias("n"),
        F.sum(F.when(hit, _rows(weight)).otherwise(0)).alias("c"),
        F.coalesce(F.sum(F.when(mixed, _rows(weight)).otherwise(0)), F.lit(0)).cast("bigint").alias("n_mixed"),
        F.sum(F.when(mixed & hit, _rows(weight)).otherwise(0)).alias("c_mixed"),
    )
    rated = sums.select(
        "n_mixed",
        _share(F.col("c"), F.col("n")).alias("overall_acc"),
        _share(F.col("c_mixed"), F.col("n_mixed")).alias("mixed_acc"),
    ).withColumn("gap", (F.col("overall_acc") - F.col("mixed_acc")) * F.lit(100.0))
    return rated.withColumn("skipped", F.col("n_mixed") == 0).withColumn(
        "passed", F.coalesce(F.col("gap") <= F.lit(float(max_gap)), F.lit(True))
    )


def length_buckets(
    df: DataFrame, floor: float = fv.LENGTH_FLOOR, weight: str | None = None
) -> DataFrame:
    """Accuracy of short, medium and long texts; an empty bucket is shown and passes."""
    named = df if "bucket" in df.columns else df.withColumn("bucket", length_bucket(F.col("text")))
    sums = named.groupBy("bucket").agg(
        F.sum(_rows(weight)).cast("bigint").alias("n"), _correct(weight).cast("bigint").alias("correct")
    )
    every = df.sparkSession.createDataFrame([(b,) for b in BUCKETS], "bucket string")
    joined = every.join(sums, "bucket", "left").withColumn("accuracy", _share(F.col("correct"), F.col("n")))
    return joined.select(
        "bucket",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        "accuracy",
        F.coalesce(F.col("accuracy") >= F.lit(float(floor)), F.lit(True)).alias("passed"),
    )


# --- hard negatives ---------------------------------------------------------------------


def usable_signals(signals: DataFrame) -> DataFrame:
    """Lower-cased signals; those that start with ``"no "`` or are shorter than 3 are dropped."""
    kept = signals.filter(~F.startswith("signal", F.lit("no ")) & (F.length("signal") >= 3))
    return kept.withColumn("signal", F.lower("signal"))


def hard_negatives(df: DataFrame, signals: DataFrame, signal_rows: int | None = None) -> DataFrame:
    """Rows labelled A whose text contains a signal of B against A: one row per (row, A, B), and as many for equal rows of ``df``.

    Up to ``signal_rows`` (``SIGNAL_ROWS``) short signals are looked up as arrays by class. More of them become automata, that find all
    signals in one walk over a text: the texts stay where they are, whatever the number of signals and rows of a class.
    """
    usable = usable_signals(signals).filter(F.col("label_a") != F.col("label_b"))
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("signal")).alias("bytes")).first()
    if size.n > (SIGNAL_ROWS if signal_rows is None else signal_rows) or (size.bytes or 0) > SIGNAL_BYTES:
        return _by_automata(df, usable, size.bytes or 0)
    pairs = usable.groupBy("label_a", "label_b").agg(F.collect_set("signal").alias("signals"))
    by_label = pairs.groupBy("label_a").agg(F.collect_list(F.struct("label_b", "signals")).alias("__pairs"))
    lowered = df.withColumn("__low", F.lower("text"))
    joined = lowered.join(F.broadcast(by_label), F.col("label") == F.col("label_a"), "inner")
    found = F.transform(
        "__pairs",
        lambda p: F.when(F.exists(p["signals"], lambda s: F.contains(F.col("__low"), s)), p["label_b"]),
    )
    return (
        joined.withColumn("__found", found)
        .withColumn("label_b", F.explode_outer("__found"))
        .filter(F.col("label_b").isNotNull())
        .drop("__low", "__pairs", "__found")
    )


def _by_automata(df: DataFrame, usable: DataFrame, size: int) -> DataFrame:
    """Hard negatives by automata of ``AUTOMATON_BYTES`` of signals each, sent to the tasks one after the other.

    With several automata the rows are written once, under an id, and a pair that several automata find counts once.
    """
    pairs = F.collect_set(F.struct("label_a", "label_b"))
    signals = usable.groupBy("signal").agg(pairs.alias("pairs"))  # a signal has classes x classes pairs at most
    number = -(-size // AUTOMATON_BYTES)
    schema = StructType([*df.schema.fields, StructField("label_a", StringType()), StructField("label_b", StringType())])
    if number <= 1:
        return df.withColumn("__low", F.lower("text")).mapInArrow(_found_by(signals, df.columns.index("label")), schema)
    ensure_checkpoint_dir(df.sparkSession)
    written = df.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    texts = written.select("__id", "label", F.lower("text").alias("__low"))
    signals = signals.withColumn("__part", F.pmod(F.xxhash64("signal"), F.lit(number))).checkpoint()
    found = None
    for part in range(number):
        own = signals.filter(F.col("__part") == part)
        hits = texts.mapInArrow(_found_by(own, 1), "__id long, label string, label_a string, label_b string").select("__id", "label_b")
        found = hits if found is None else found.unionByName(hits)
    named = written.join(found.distinct(), "__id").withColumn("label_a", F.col("label"))
    return named.select(*df.columns, "label_a", "label_b")


def _found_by(signals: DataFrame, label: int):
    """Rows repeated for each class whose signal they contain; the last column is the lower-cased text."""
    table = [(r["signal"], [tuple(p) for p in r["pairs"]]) for r in signals.select("signal", "pairs").toLocalIterator()]
    shared = signals.sparkSession.sparkContext.broadcast(table)  # ``AUTOMATON_BYTES`` of signals, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, against = ahocorasick.Automaton(), defaultdict(set)
        for signal, pairs in shared.value:
            of = defaultdict(set)
            for a, b in pairs:
                of[a].add(b)
                against[a].add(b)
            machine.add_word(signal, dict(of))
        if against:
            machine.make_automaton()
        for batch in batches:
            rows, found = [], []
            for i, (a, low) in enumerate(zip(batch.column(label).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)):
                if not low or a not in against:
                    continue
                hits: set[str] = set()
                for _, of in machine.iter(low):
                    if a in of:
                        hits |= of[a]
                        if len(hits) == len(against[a]):
                            break
                rows += [i] * len(hits)
                found += sorted(hits)
            own = pa.array(rows, pa.int64())
            columns = [c.take(own) for c in batch.columns[:-1]]
            names = [*batch.schema.names[:-1], "label_a", "label_b"]
            yield pa.RecordBatch.from_arrays([*columns, columns[label].cast(pa.string()), pa.array(found, pa.string())], names)

    return run


def hard_negative_accuracy(
    df: DataFrame, signals: DataFrame, floor: float = fv.HARD_NEGATIVE_FLOOR
) -> DataFrame:
    return (
        hard_negatives(df, signals)
        .groupBy("label_a", "label_b")
        .agg(F.count(F.lit(1)).alias("n"), _correct(None).cast("bigint").alias("correct"))
        .withColumn("accuracy", _share(F.col("correct"), F.col("n")))
        .withColumn("passed", F.col("accuracy") >= F.lit(float(floor)))
    )


# --- latency and throughput ------------------------------------------------------------


def latency_stats(
    df: DataFrame, keys: list[str], value: str = "ms", median: str = "upper", target: float = fv.LATENCY_MS
) -> DataFrame:
    """p50 and p95 of a timing table. ``median``: ``upper`` (element n div 2) or ``midpoint``."""
    ranks = {
        "__lower": lambda n: F.floor((n - 1) / 2),
        "__upper": lambda n: F.floor(n / 2),
        "p95": lambda n: F.floor(n * F.lit(0.95)),
    }
    if median == "upper":
        del ranks["__lower"]
    elif median != "midpoint":
        raise ValueError(f"median: {median}")
    stats = order_statistics(df, keys, value, ranks)
    p50 = F.col("__upper") if median == "upper" else (F.col("__lower") + F.col("__upper")) / 2
    return stats.select(*keys, "n", p50.alias("p50"), "p95").withColumn("passed", F.col("p50") <= F.lit(target))


def rate_stats(
    df: DataFrame, keys: list[str], tokens: str = "out_tokens", elapsed: str = "elapsed_s"
) -> DataFrame:
    """Tokens per second: total tokens; median, mean, min and max of the request rates."""
    rate = F.when(F.col(elapsed) > 0, F.col(tokens) / F.col(elapsed)).otherwise(F.lit(0.0))
    rated = df.withColumn("__rate", rate.cast("double"))
    plain = rated.groupBy(*keys).agg(
        F.sum(tokens).alias("total_tokens"),
        F.avg("__rate").alias("mean_rate"),
        F.min("__rate").alias("min_rate"),
        F.max("__rate").alias("max_rate"),
    )
    middle = latency_stats(rated, keys, "__rate", median="midpoint").select(
        *keys, "n", F.col("p50").alias("median_rate")
    )
    return join_on(plain, middle, keys, "inner")


# --- training history --------------------------------------------------------------------


def log_loss(df: DataFrame, logits: str = "logits", label_idx: str = "label_idx") -> DataFrame:
    """Mean cross-entropy and accuracy of scored rows."""
    scores = F.col(logits).cast("array<double>")
    target = F.get(scores, F.col(label_idx))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(log_sum_exp(scores) - target).alias("loss"),
        _share(F.sum((argmax(scores) == F.col(label_idx)).cast("bigint")), F.count(F.lit(1))).alias("accuracy"),
    )


def early_stopping(
    history: DataFrame, patience: int = fv.PATIENCE, order: str = "epoch", block_rows: int = 65_536
) -> DataFrame:
    """Per run: best epoch (first strict minimum of ``val_loss``), stop epoch and whether it stopped.

    ``order`` is an integer that rises within a run. Epochs after the stop are not counted. The history is read once:
    blocks of epochs are summed up apart (see ``stopping``), and the summaries of a run, of fixed size, are combined in order.
    """
    if patience < 1:
        raise ValueError("patience: 1 or more")
    run, epoch = history.schema["run_id"].dataType.simpleString(), history.schema[order].dataType.simpleString()
    rows = history.select(
        "run_id", F.floor(F.col(order) / F.lit(block_rows)).alias("block"), F.col(order).cast("long").alias("epoch"),
        F.col("val_loss").cast("double").alias("loss"),
    )
    dealt = rows.repartition("run_id", "block").sortWithinPartitions("run_id", "block", "epoch")
    blocks = dealt.mapInArrow(
        stopping.blocks(patience),
        f"run_id {run}, block long, n long, epochs array<long>, places array<long>, losses array<double>, "
        "stop_at long, stop_epoch long, stop_best_epoch long, stop_best_loss double, best_at long, best_epoch long, best_loss double, last_epoch long",
    )
    ordered = blocks.repartition("run_id").sortWithinPartitions("run_id", "block")
    ends = ordered.mapInArrow(
        stopping.runs(patience),
        f"run_id {run}, best_epoch long, best_val_loss double, last_epoch long, epochs_run long, stopped_early boolean",
    )
    return ends.withColumns({name: F.col(name).cast(epoch) for name in ("best_epoch", "last_epoch")})


# --- gates ----------------------------------------------------------------------------------


def _verdict(df: DataFrame, axis: str, passed: Column) -> DataFrame:
    return df.agg(F.coalesce(F.bool_and(passed), F.lit(True)).alias("passed")).select(
        F.lit(axis).alias("axis"), "passed"
    )


def _with_overall(axes: list[DataFrame], key: str = "axis") -> DataFrame:
    rows = axes[0]
    for other in axes[1:]:
        rows = rows.unionByName(other)
    # a handful of verdict rows: overall is the grand-total grouping set
    return rows.groupingSets([[F.col(key)], []], key).agg(F.bool_and("passed").alias("passed")).select(
        F.coalesce(key, F.lit("overall")).alias(key), "passed"
    )


def small_copy(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Local copy of a small aggregate; a larger one is checkpointed in the shared folder."""
    small = local_copy(df, max_rows)
    if small is not None:
        return small
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def evaluate(
    scored: DataFrame,
    classes: list[str],
    signals: DataFrame | None = None,
    latency: DataFrame | None = None,
    f1_floor: float = fv.F1_FLOOR,
    mixed_lang: str = fv.MIXED_LANG,
) -> DataFrame:
    """Verdict per axis and overall. Only the hard negatives read the texts a second time."""
    cells = small_copy(scored_cells(scored))
    axes = [
        _verdict(per_class_metrics(cells, classes, "n"), "per_class_f1", F.col("f1") >= F.lit(float(f1_floor))),
        _verdict(crosslingual(cells, weight="n"), "crosslingual", ~F.col("flagged")),
        _verdict(codeswitch(cells, mixed_lang, weight="n"), "codeswitch", F.col("passed")),
        _verdict(length_buckets(cells, weight="n"), "length_buckets", F.col("passed")),
    ]
    if signals is not None:
        axes.append(_verdict(hard_negative_accuracy(scored, signals), "hard_negatives", F.col("passed")))
    if latency is not None:
        axes.append(_verdict(latency_stats(latency, []), "latency", F.col("passed")))
    return _with_overall(axes)


def evaluation_report(
    scored: DataFrame,
    classes: list[str],
    signals: DataFrame | None = None,
    latency: DataFrame | None = None,
    f1_floor: float = fv.F1_FLOOR,
    mixed_lang: str = fv.MIXED_LANG,
) -> DataFrame:
    """The figures behind ``evaluate``: axis, key, metric, n, value, bound and passed of every class, language gap, length,
    pair of hard negatives and latency group. A value is NULL where there are no rows; such an axis passes."""
    cells = small_copy(scored_cells(scored))

    def figures(df: DataFrame, axis: str, key: Column, metric: str, n: Column, value: Column, bound: float, passed: Column) -> DataFrame:
        return df.select(
            F.lit(axis).alias("axis"), key.alias("key"), F.lit(metric).alias("metric"), n.cast("bigint").alias("n"),
            value.cast("double").alias("value"), F.lit(float(bound)).alias("bound"), passed.alias("passed"),
        )

    f1 = F.col("f1")
    rows = [
        figures(per_class_metrics(cells, classes, "n"), "per_class_f1", F.col("label"), "f1", F.col("support"), f1, f1_floor, f1 >= F.lit(float(f1_floor))),
        figures(
            crosslingual(cells, weight="n"), "crosslingual", F.col("label"), "gap_pp", F.col("n_langs"), F.col("gap"), fv.LANGUAGE_GAP_PP, ~F.col("flagged")
        ),
        figures(
            codeswitch(cells, mixed_lang, weight="n"), "codeswitch", F.lit(mixed_lang), "gap_pp", F.col("n_mixed"), F.col("gap"), fv.CODESWITCH_GAP_PP,
            F.col("passed"),
        ),
        figures(
            length_buckets(cells, weight="n"), "length_buckets", F.col("bucket"), "accuracy", F.col("n"), F.col("accuracy"), fv.LENGTH_FLOOR, F.col("passed")
        ),
    ]
    if signals is not None:
        pair = F.concat_ws("|", "label_a", "label_b")
        hard = hard_negative_accuracy(scored, signals)
        rows.append(figures(hard, "hard_negatives", pair, "accuracy", F.col("n"), F.col("accuracy"), fv.HARD_NEGATIVE_FLOOR, F.col("passed")))
    if latency is not None:
        rows.append(
            figures(latency_stats(latency, []), "latency", F.lit("all"), "p50_ms", F.col("n"), F.col("p50"), fv.LATENCY_MS, F.col("passed"))
        )
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


def release_gates(
    metrics: DataFrame,
    latency: DataFrame,
    f1_floor: float = fv.F1_FLOOR,
    recall_class: str | None = None,
    recall_floor: float = fv.RECALL_FLOOR,
) -> DataFrame:
    """One row per gate: every class F1, recall of one class if it exists, p50, and overall."""
    f1 = metrics.select(
        F.concat(F.lit("f1:"), "label").alias("gate"), (F.col("f1") >= F.lit(float(f1_floor))).alias("passed")
    )
    gates = [f1, latency.select(F.lit("latency_p50").alias("gate"), "passed")]
    if recall_class is not None:
        gates.append(
            metrics.filter(F.col("label") == F.lit(recall_class)).select(
                F.concat(F.lit("recall:"), "label").alias("gate"),
                (F.col("recall") >= F.lit(float(recall_floor))).alias("passed"),
            )
        )
    return _with_overall(gates, "gate")

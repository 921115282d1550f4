"""Evaluation operators on synthetic predictions, events, line items and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.functions.text import argmax, softmax
from labelloom.operators import evaluate as ev

from .kit import CLASSES, CLASSES_SQL, SCORED_SQL, quote, scored, table, values

# (class B, class A, signal): words of the documents, with unusable signals among them
SIGNALS = [
    ("simple", "reasoning", "The"), ("simple", "reasoning", "no file references"), ("simple", "agentic", "ouen"),
    ("simple", "agentic", "ab"), ("reasoning", "simple", "und "), ("reasoning", "simple", "tion"),
    ("reasoning", "agentic", "QUE"), ("agentic", "simple", "de la"), ("agentic", "reasoning", "zzzz never"),
    ("agentic", "agentic", "and"),
]
MIXED = "fr"


def _signals(spark):
    return spark.createDataFrame(SIGNALS, "label_b string, label_a string, signal string")


def _latency(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("group_key"), F.col("value").alias("ms"))


def _token_log(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_returnflag").alias("group_key"),
        F.col("l_quantity").cast("bigint").alias("out_tokens"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_extendedprice")).alias("elapsed_s"),
    )


def _logits(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("logits"), F.col("label").alias("label_idx")
    )


def subset_accuracy(spark, sf_dir):
    rows = scored(spark, sf_dir)
    french = ev.subset_accuracy(rows, F.col("lang") == "fr").select(F.lit("fr").alias("subset"), "*")
    none = ev.subset_accuracy(rows, F.col("lang") == "xx").select(F.lit("xx").alias("subset"), "*")
    return french.unionByName(none)


def log_loss(spark, sf_dir):
    return ev.log_loss(_logits(spark, sf_dir)).select("n", F.round("loss", 6).alias("loss"), "accuracy")


def early_stopping(spark, sf_dir):
    history = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("epoch"), F.col("value").alias("val_loss")
    )
    return ev.early_stopping(history, block_rows=1000)


def usable_signals(spark, sf_dir):
    """Words of the benchmark texts as signals, some of them unusable."""
    items = table(spark, sf_dir, "benchmark")
    words = items.select("item_id", F.explode(F.split("text", " ")).alias("word"))
    signal = F.when(F.length("word") == 4, F.concat(F.lit("no "), "word")).otherwise(F.col("word"))
    return ev.usable_signals(words.select("item_id", signal.alias("signal")))


def hard_negatives(spark, sf_dir):
    return ev.hard_negatives(scored(spark, sf_dir), _signals(spark)).select("record_id", "label_a", "label_b")


def hard_negatives_many(spark, sf_dir):
    """Every word of the benchmark texts is a signal, looked up by automata."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("signal")).distinct()
    names = F.array(*[F.lit(c) for c in CLASSES])
    at = F.length("signal") % len(CLASSES)
    signals = words.select(
        "signal", F.get(names, at).alias("label_a"), F.get(names, (at + 1 + F.length("signal") % 2) % len(CLASSES)).alias("label_b")
    )
    return ev.hard_negatives(scored(spark, sf_dir), signals, signal_rows=0).select("record_id", "label_a", "label_b")


def evaluation_report(spark, sf_dir):
    out = ev.evaluation_report(scored(spark, sf_dir), CLASSES, _signals(spark), _latency(spark, sf_dir), 0.75, MIXED)
    return out.withColumn("value", F.round("value", 9))


def rate_stats(spark, sf_dir):
    stats = ev.rate_stats(_token_log(spark, sf_dir), ["group_key"])
    return stats.select(
        "group_key", "n", "total_tokens", *[F.round(c, 9).alias(c) for c in ("median_rate", "mean_rate", "min_rate", "max_rate")]
    )


def gate_rollup(spark, sf_dir):
    return ev.evaluate(scored(spark, sf_dir), CLASSES, _signals(spark), _latency(spark, sf_dir), 0.75, MIXED)


def release_gates(spark, sf_dir):
    metrics = ev.per_class_metrics(scored(spark, sf_dir), CLASSES)
    latency = ev.latency_stats(_latency(spark, sf_dir), [])
    return ev.release_gates(metrics, latency, 0.8, "agentic", 0.79)


def per_class_metrics(spark, sf_dir):
    return ev.per_class_metrics(scored(spark, sf_dir), [*CLASSES, "unused"])


def argmax_scores(spark, sf_dir):
    return _logits(spark, sf_dir).select("vec_id", argmax(F.col("logits")).cast("bigint").alias("best"))


def softmax_confidence(spark, sf_dir):
    shares = softmax(F.col("logits"))
    return _logits(spark, sf_dir).select(
        "vec_id", F.round(F.array_max(shares), 6).alias("confidence"), F.round(F.get(shares, F.lit(0)), 6).alias("first")
    )


QUERIES = {
    "confusion_matrix": lambda s, d: ev.confusion_matrix(scored(s, d), [*CLASSES, "unused"]),
    "per_class_metrics": per_class_metrics,
    "accuracy": lambda s, d: ev.accuracy(scored(s, d)),
    "subset_accuracy": subset_accuracy,
    "crosslingual": lambda s, d: ev.crosslingual(scored(s, d)),
    "language_table": lambda s, d: ev.language_table(scored(s, d), ["en", "fr", "de", "es"]),
    "codeswitch": lambda s, d: ev.codeswitch(scored(s, d), MIXED),
    "length_buckets": lambda s, d: ev.length_buckets(scored(s, d)),
    "usable_signals": usable_signals,
    "hard_negatives": hard_negatives,
    "hard_negative_accuracy": lambda s, d: ev.hard_negative_accuracy(scored(s, d), _signals(s)),
    "latency_stats": lambda s, d: ev.latency_stats(_latency(s, d), ["group_key"]),
    "latency_midpoint": lambda s, d: ev.latency_stats(_latency(s, d), ["group_key"], median="midpoint"),
    "rate_stats": rate_stats,
    "log_loss": log_loss,
    "early_stopping": early_stopping,
    "gate_rollup": gate_rollup,
    "evaluation_report": evaluation_report,
    "hard_negatives_many": hard_negatives_many,
    "release_gates": release_gates,
    "argmax_scores": argmax_scores,
    "softmax_confidence": softmax_confidence,
}

_HIT = "CAST(sum(CAST(pred = label AS BIGINT)) AS BIGINT)"
_EVERY = "every(label, idx) AS " + values([(c, i) for i, c in enumerate([*CLASSES, "unused"])])


def _metrics(classes: str) -> str:
    return f"""sums AS (
  SELECT c.label, c.idx,
    count(*) FILTER (s.label = c.label) AS support,
    count(*) FILTER (s.pred = c.label) AS predicted,
    count(*) FILTER (s.pred = c.label AND s.label = c.label) AS tp
  FROM {classes} c LEFT JOIN scored s ON s.label = c.label OR s.pred = c.label GROUP BY c.label, c.idx),
pr AS (SELECT *, coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS precision,
         coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall FROM sums),
metrics AS (SELECT label, idx, precision, recall,
  coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support FROM pr)"""


_CLASS_LIST = "[" + ", ".join(quote(c) for c in CLASSES) + "]"
_CELLS = f"""cells AS (SELECT label, lang, {_HIT} AS correct, count(*) AS n,
  {_HIT} / CAST(count(*) AS DOUBLE) AS accuracy FROM scored GROUP BY label, lang)"""
_CROSS = """crossl AS (SELECT label, count(*) AS n_langs, min(accuracy) AS min_acc, max(accuracy) AS max_acc,
  (max(accuracy) - min(accuracy)) * CAST(100 AS DOUBLE) AS gap,
  count(*) >= 2 AND (max(accuracy) - min(accuracy)) * CAST(100 AS DOUBLE) > CAST(10 AS DOUBLE) AS flagged
  FROM cells GROUP BY label)"""
_SWITCH = f"""sw AS (SELECT count(*) FILTER (lang = '{MIXED}') AS n_mixed,
  {_HIT} / CAST(count(*) AS DOUBLE) AS overall_acc,
  count(*) FILTER (lang = '{MIXED}' AND pred = label) / CAST(nullif(count(*) FILTER (lang = '{MIXED}'), 0) AS DOUBLE) AS mixed_acc
  FROM scored),
switch AS (SELECT *, (overall_acc - mixed_acc) * CAST(100 AS DOUBLE) AS gap, n_mixed = 0 AS skipped,
  coalesce((overall_acc - mixed_acc) * CAST(100 AS DOUBLE) <= CAST(5 AS DOUBLE), true) AS passed FROM sw)"""
_LENGTHS = f"""lengths AS (SELECT b.bucket, count(s.label) AS n,
  {_HIT} / CAST(nullif(count(s.label), 0) AS DOUBLE) AS accuracy,
  coalesce({_HIT} / CAST(nullif(count(s.label), 0) AS DOUBLE) >= CAST(0.7 AS DOUBLE), true) AS passed
  FROM (VALUES ('short'), ('medium'), ('long')) b(bucket) LEFT JOIN scored s ON b.bucket =
    CASE WHEN length(s.text) <= 30 THEN 'short' WHEN length(s.text) <= 120 THEN 'medium' ELSE 'long' END
  GROUP BY b.bucket)"""
_HARD = f"""signals(label_b, label_a, signal) AS {values(SIGNALS)},
hard AS (SELECT DISTINCT s.record_id, g.label_a, g.label_b, s.label, s.pred FROM scored s
  JOIN signals g ON g.label_a = s.label AND g.label_a <> g.label_b
    AND NOT starts_with(g.signal, 'no ') AND length(g.signal) >= 3 AND contains(lower(s.text), lower(g.signal))),
hard_acc AS (SELECT label_a, label_b, count(*) AS n, {_HIT} AS correct, {_HIT} / CAST(count(*) AS DOUBLE) AS accuracy,
  {_HIT} / CAST(count(*) AS DOUBLE) >= CAST(0.75 AS DOUBLE) AS passed FROM hard GROUP BY label_a, label_b)"""


def _latency_sql(key: str, p50: str) -> str:
    return f"""sorted AS (SELECT {key} AS group_key, list_sort(list(value)) AS v, count(*) AS n FROM events GROUP BY 1),
lat AS (SELECT group_key, n, {p50} AS p50, v[CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1] AS p95 FROM sorted),
latency AS (SELECT *, p50 <= CAST(50 AS DOUBLE) AS passed FROM lat)"""


_UPPER = "v[n // 2 + 1]"
_MIDDLE = "(v[(n - 1) // 2 + 1] + v[n // 2 + 1]) / 2"

ORACLES = {
    "confusion_matrix": f"""WITH {SCORED_SQL}, {_EVERY}
        SELECT a.label, b.label AS pred, count(s.record_id) AS n FROM every a CROSS JOIN every b
        LEFT JOIN scored s ON s.label = a.label AND s.pred = b.label GROUP BY a.label, b.label""",
    "per_class_metrics": f"WITH {SCORED_SQL}, {_EVERY}, {_metrics('every')} SELECT * FROM metrics",
    "accuracy": f"""WITH {SCORED_SQL} SELECT count(*) AS n, {_HIT} AS correct,
        {_HIT} / CAST(count(*) AS DOUBLE) AS accuracy FROM scored""",
    "subset_accuracy": f"""WITH {SCORED_SQL} SELECT subset, count(label) AS n, coalesce({_HIT}, 0) AS correct,
        {_HIT} / CAST(nullif(count(label), 0) AS DOUBLE) AS accuracy
        FROM (VALUES ('fr'), ('xx')) v(subset) LEFT JOIN scored ON lang = subset GROUP BY subset""",
    "crosslingual": f"WITH {SCORED_SQL}, {_CELLS}, {_CROSS} SELECT * FROM crossl",
    "language_table": f"""WITH {SCORED_SQL}, {_CELLS} SELECT label,
        max(accuracy) FILTER (lang = 'en') AS en, max(accuracy) FILTER (lang = 'fr') AS fr,
        max(accuracy) FILTER (lang = 'de') AS de, max(accuracy) FILTER (lang = 'es') AS es FROM cells GROUP BY label""",
    "codeswitch": f"WITH {SCORED_SQL}, {_SWITCH} SELECT * FROM switch",
    "length_buckets": f"WITH {SCORED_SQL}, {_LENGTHS} SELECT * FROM lengths",
    "usable_signals": """WITH w AS (SELECT item_id, unnest(string_split(text, ' ')) AS word FROM benchmark),
        s AS (SELECT item_id, CASE WHEN length(word) = 4 THEN 'no ' || word ELSE word END AS signal FROM w)
        SELECT item_id, lower(signal) AS signal FROM s WHERE signal NOT LIKE 'no %' AND length(signal) >= 3""",
    "hard_negatives": f"WITH {SCORED_SQL}, {_HARD} SELECT record_id, label_a, label_b FROM hard",
    "hard_negative_accuracy": f"WITH {SCORED_SQL}, {_HARD} SELECT * FROM hard_acc",
    "latency_stats": f"WITH {_latency_sql('event_type', _UPPER)} SELECT * FROM latency",
    "latency_midpoint": f"WITH {_latency_sql('event_type', _MIDDLE)} SELECT * FROM latency",
    "rate_stats": """WITH t AS (SELECT l_returnflag AS group_key, CAST(l_quantity AS BIGINT) AS tokens,
          CASE WHEN l_linenumber = 7 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS elapsed FROM lineitem),
        r AS (SELECT *, CASE WHEN elapsed > 0 THEN tokens / elapsed ELSE 0 END AS rate FROM t)
        SELECT group_key, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS total_tokens, round(median(rate), 9) AS median_rate,
          round(avg(rate), 9) AS mean_rate, round(min(rate), 9) AS min_rate, round(max(rate), 9) AS max_rate
        FROM r GROUP BY group_key""",
    "log_loss": """WITH e AS (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS l, label FROM embeddings),
        m AS (SELECT l, label, list_max(l) AS top FROM e),
        s AS (SELECT *, top + ln(list_sum(list_transform(l, lambda x: exp(x - top)))) - l[label + 1] AS loss FROM m)
        SELECT count(*) AS n, round(avg(loss), 6) AS loss,
          CAST(sum(CAST(list_position(l, top) - 1 = label AS BIGINT)) AS DOUBLE) / count(*) AS accuracy FROM s""",
    "early_stopping": """WITH h AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS epoch, value AS val_loss,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events),
        i AS (SELECT *, val_loss < coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE)) AS improved FROM h),
        l AS (SELECT *, max(CASE WHEN improved THEN pos END) OVER (PARTITION BY run_id ORDER BY pos) AS last_hit FROM i),
        s AS (SELECT *, min(CASE WHEN pos - last_hit >= 3 THEN pos END) OVER (PARTITION BY run_id) AS stop_pos,
          max(pos) OVER (PARTITION BY run_id) AS end_pos FROM l),
        f AS (SELECT * FROM s WHERE pos = coalesce(stop_pos, end_pos))
        SELECT f.run_id, b.epoch AS best_epoch, b.val_loss AS best_val_loss, f.epoch AS last_epoch,
          f.pos AS epochs_run, f.stop_pos IS NOT NULL AS stopped_early
        FROM f JOIN h b ON b.run_id = f.run_id AND b.pos = f.last_hit""",
    "gate_rollup": f"""WITH {SCORED_SQL}, {CLASSES_SQL}, {_metrics('classes')}, {_CELLS}, {_CROSS}, {_SWITCH}, {_LENGTHS},
        {_HARD}, {_latency_sql("'all'", _UPPER)},
        axes AS (SELECT 'per_class_f1' AS axis, bool_and(f1 >= CAST(0.75 AS DOUBLE)) AS passed FROM metrics
          UNION ALL SELECT 'crosslingual', bool_and(NOT flagged) FROM crossl
          UNION ALL SELECT 'codeswitch', bool_and(passed) FROM switch
          UNION ALL SELECT 'length_buckets', bool_and(passed) FROM lengths
          UNION ALL SELECT 'hard_negatives', coalesce(bool_and(passed), true) FROM hard_acc
          UNION ALL SELECT 'latency', bool_and(passed) FROM latency)
        SELECT * FROM axes UNION ALL SELECT 'overall', bool_and(passed) FROM axes""",
    "hard_negatives_many": f"""WITH {SCORED_SQL}, words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS signal FROM benchmark),
        pairs AS (SELECT signal, {_CLASS_LIST}[length(signal) % {len(CLASSES)} + 1] AS label_a,
          {_CLASS_LIST}[(length(signal) % {len(CLASSES)} + 1 + length(signal) % 2) % {len(CLASSES)} + 1] AS label_b FROM words)
        SELECT DISTINCT s.record_id, g.label_a, g.label_b FROM scored s JOIN pairs g ON g.label_a = s.label AND g.label_a <> g.label_b
          AND NOT starts_with(g.signal, 'no ') AND length(g.signal) >= 3 AND contains(lower(s.text), lower(g.signal))""",
    "evaluation_report": f"""WITH {SCORED_SQL}, {CLASSES_SQL}, {_metrics('classes')}, {_CELLS}, {_CROSS}, {_SWITCH}, {_LENGTHS},
        {_HARD}, {_latency_sql("'all'", _UPPER)},
        r(axis, key, metric, n, value, bound, passed) AS (
          SELECT 'per_class_f1', label, 'f1', support, f1, 0.75, f1 >= CAST(0.75 AS DOUBLE) FROM metrics
          UNION ALL SELECT 'crosslingual', label, 'gap_pp', n_langs, gap, 10, NOT flagged FROM crossl
          UNION ALL SELECT 'codeswitch', '{MIXED}', 'gap_pp', n_mixed, gap, 5, passed FROM switch
          UNION ALL SELECT 'length_buckets', bucket, 'accuracy', n, accuracy, 0.7, passed FROM lengths
          UNION ALL SELECT 'hard_negatives', label_a || '|' || label_b, 'accuracy', n, accuracy, 0.75, passed FROM hard_acc
          UNION ALL SELECT 'latency', 'all', 'p50_ms', n, p50, 50, passed FROM latency)
        SELECT axis, key, metric, CAST(n AS BIGINT) AS n, round(CAST(value AS DOUBLE), 9) AS value, CAST(bound AS DOUBLE) AS bound, passed FROM r""",
    "release_gates": f"""WITH {SCORED_SQL}, {CLASSES_SQL}, {_metrics('classes')}, {_latency_sql("'all'", _UPPER)},
        gates AS (SELECT 'f1:' || label AS gate, f1 >= CAST(0.8 AS DOUBLE) AS passed FROM metrics
          UNION ALL SELECT 'latency_p50', passed FROM latency
          UNION ALL SELECT 'recall:' || label, recall >= CAST(0.79 AS DOUBLE) FROM metrics WHERE label = 'agentic')
        SELECT * FROM gates UNION ALL SELECT 'overall', bool_and(passed) FROM gates""",
    "argmax_scores": """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best
        FROM embeddings""",
    "softmax_confidence": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS l FROM embeddings),
        m AS (SELECT vec_id, l, list_max(l) AS top FROM e),
        t AS (SELECT *, list_sum(list_transform(l, lambda x: exp(x - top))) AS total FROM m)
        SELECT vec_id, round(1 / total, 6) AS confidence, round(exp(l[1] - top) / total, 6) AS first FROM t""",
}

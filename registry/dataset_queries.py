"""Dataset operators: joins, split, sample, cap, shuffle, unions, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom import fixed_values as fv
from labelloom.functions.draws import unit
from labelloom.operators import datasets as ds
from labelloom.operators.expand import with_conv_type

from .kit import (
    CLASSES,
    CLASSES_SQL,
    LANGS,
    RECORDS_SQL,
    SCORED_SQL,
    SEED,
    predictions,
    quote,
    records,
    spread,
    sql_draw,
    sql_weighted,
    sql_unit,
    table,
)

N_PER_CELL = 30  # rows wanted per (source, lang)


def _by_priority(spark, sf_dir):
    orders = spread(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    return orders.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderpriority").alias("label"))


def stratified_split(spark, sf_dir):
    return ds.stratified_split(_by_priority(spark, sf_dir)).select("record_id", "label", "split")


SPLIT_SQL = f"""
WITH r AS (SELECT o_orderkey AS record_id, o_orderpriority AS label FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_draw('record_id', 'split')}, record_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM r)
SELECT record_id, label,
  CASE WHEN rn <= greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)) THEN 'val' ELSE 'train' END AS split
FROM k
"""


def split_by_origin(spark, sf_dir):
    """Rows of one source text (here: equal text) stay on the same side."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("record_id"), "text", F.col("lang").alias("label"))
    return ds.stratified_split(rows, group_col="text").select("record_id", "label", "split")


SPLIT_ORIGIN_SQL = f"""
WITH r AS (SELECT doc_id AS record_id, lang AS label, md5(text) AS unit FROM documents),
u AS (SELECT DISTINCT label, unit FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_draw('unit', 'split')}, unit) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM u)
SELECT record_id, r.label,
  CASE WHEN rn <= greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)) THEN 'val' ELSE 'train' END AS split
FROM r JOIN k ON k.label = r.label AND k.unit = r.unit
"""


def _sample_size(spark, sf_dir, share=10):
    """A tenth of the table, plus one so that the remainder matters."""
    return _by_priority(spark, sf_dir).count() // share + 1


def stratified_sample(spark, sf_dir):
    rows = _by_priority(spark, sf_dir)
    return ds.stratified_sample(rows, _sample_size(spark, sf_dir)).select("record_id", "label")


SAMPLE_SQL = f"""
WITH r AS (SELECT o_orderkey AS record_id, o_orderpriority AS label FROM orders),
n AS (SELECT count(*) // 10 + 1 AS n FROM r),
l AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i, count(*) OVER () AS k FROM (SELECT DISTINCT label FROM r)),
q AS (SELECT label, n // k + CASE WHEN i < n % k THEN 1 ELSE 0 END AS quota FROM l, n),
k AS (SELECT r.*, quota, row_number() OVER (PARTITION BY r.label ORDER BY {sql_draw('record_id', 'sample', 99)}, record_id) AS rn
      FROM r JOIN q ON q.label = r.label)
SELECT record_id, label FROM k WHERE rn <= quota
"""


def wanted(spark, sf_dir):
    """Wanted classes of every task: one task per source, one class per language."""
    tasks = table(spark, sf_dir, "documents").select(F.col("source").alias("task_id")).distinct()
    return tasks.select("task_id", F.explode(F.array(*[F.lit(x) for x in LANGS])).alias("label"))


def task_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("task_id"), F.col("lang").alias("label"), "doc_id")


def class_deficit(spark, sf_dir):
    found = ds.class_deficit(
        task_records(spark, sf_dir), wanted(spark, sf_dir), N_PER_CELL, ["task_id", "label"]
    )
    return found.select("task_id", "label", "have", "need")


WANTED_SQL = f"wanted AS (SELECT DISTINCT source AS task_id, unnest([{', '.join(quote(x) for x in LANGS)}]) AS label FROM documents)"
DEFICIT_SQL = f"""{WANTED_SQL}, deficit AS (
  SELECT w.task_id, w.label, count(d.doc_id) AS have, {N_PER_CELL} - count(d.doc_id) AS need
  FROM wanted w LEFT JOIN documents d ON d.source = w.task_id AND d.lang = w.label
  GROUP BY w.task_id, w.label HAVING {N_PER_CELL} - count(d.doc_id) > 0)"""


def cap_per_class(spark, sf_dir):
    """Keep the first ``need`` documents of every (source, lang)."""
    rows = task_records(spark, sf_dir)
    keys = ["task_id", "label"]
    need = ds.class_deficit(rows, wanted(spark, sf_dir), N_PER_CELL, keys)
    return ds.cap_per_class(rows, need, keys, ["doc_id"])


CAP_SQL = f"""
WITH {DEFICIT_SQL},
k AS (SELECT d.source AS task_id, d.lang AS label, d.doc_id, need,
        row_number() OVER (PARTITION BY d.source, d.lang ORDER BY d.doc_id) AS rn
      FROM documents d JOIN deficit ON task_id = d.source AND label = d.lang)
SELECT task_id, label, doc_id FROM k WHERE rn <= need
"""


def resume_pending(spark, sf_dir):
    """Documents whose text is not among the texts of the documents with a label."""
    docs = table(spark, sf_dir, "documents")
    done = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return ds.pending(docs, done.select(F.col("text").alias("original_text"))).select("doc_id", "lang")


PENDING_SQL = """
SELECT doc_id, lang FROM documents WHERE text NOT IN
  (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
"""


def attach_predictions(spark, sf_dir):
    joined = ds.attach_predictions(records(spark, sf_dir), predictions(spark, sf_dir))
    return ds.with_correct(joined).select("record_id", "label", "pred", "correct")


def encode_labels(spark, sf_dir):
    classes = ds.classes_table(spark, CLASSES)
    return ds.encode_labels(records(spark, sf_dir), classes).select("record_id", "label", "label_idx")


def quarantine_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("lang", "label")
    return ds.quarantine_labels(docs, ds.classes_table(spark, ["en", "fr"])).select("doc_id", "label")


LABEL_MAP = [("en", "english"), ("fr", "french")]


def label_remap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return ds.remap_labels(docs, spark.createDataFrame(LABEL_MAP, "from_label string, to_label string"))


def merge_records(spark, sf_dir):
    """Documents, user turns and benchmark items as one bag of records."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text", F.col("lang").alias("label"))
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("record_id"), "text", F.col("role").alias("label"),
        F.col("text").alias("original_text"),
    )
    items = table(spark, sf_dir, "benchmark").select("text", F.col("item_id").alias("record_id"))
    return ds.merge(docs, turns, items)


MERGE_SQL = """
SELECT doc_id AS record_id, text, lang AS label, CAST(NULL AS VARCHAR) AS original_text FROM documents
UNION ALL SELECT conv_id * 1000 + turn, text, role, text FROM conversations
UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark
"""


def distribution(spark, sf_dir):
    return ds.distribution(_by_priority(spark, sf_dir), "label")


def languages(spark, sf_dir):
    return ds.languages(table(spark, sf_dir, "documents"))


CONV = fv.CONV_TYPES


def dataset_summary(spark, sf_dir):
    rows = with_conv_type(records(spark, sf_dir), SEED)
    noised = unit(SEED, F.col("record_id"), "noise_use") < F.lit(0.2)
    return ds.dataset_summary(rows.withColumn("noised", noised))


SUMMARY_SQL = f"""
WITH {RECORDS_SQL},
r AS (SELECT label, lang, {sql_weighted(CONV, sql_unit('record_id', 'conv_type'))} AS conv_type,
  CAST({sql_unit('record_id', 'noise_use')} < CAST(0.2 AS DOUBLE) AS BIGINT) AS noisy FROM records),
g AS (
  SELECT 'label' AS dimension, label AS value, count(*) AS n, CAST(sum(noisy) AS BIGINT) AS noised FROM r GROUP BY label
  UNION ALL SELECT 'lang', lang, count(*), CAST(sum(noisy) AS BIGINT) FROM r GROUP BY lang
  UNION ALL SELECT 'conv_type', conv_type, count(*), CAST(sum(noisy) AS BIGINT) FROM r GROUP BY conv_type
  UNION ALL SELECT 'total', '', count(*), CAST(sum(noisy) AS BIGINT) FROM r)
SELECT *, CAST(100 AS DOUBLE) * noised / n AS noised_pct FROM g
"""


def shuffle(spark, sf_dir):
    return ds.with_shuffle_position(_by_priority(spark, sf_dir)).select("record_id", "shuffle_pos")


SHUFFLE_SQL = f"""
SELECT o_orderkey AS record_id,
  row_number() OVER (ORDER BY {sql_draw('o_orderkey', 'shuffle')}, o_orderkey) - 1 AS shuffle_pos FROM orders
"""

QUERIES = {
    "stratified_split": stratified_split,
    "split_by_origin": split_by_origin,
    "stratified_sample": stratified_sample,
    "cap_per_class": cap_per_class,
    "class_deficit": class_deficit,
    "resume_pending": resume_pending,
    "merge_records": merge_records,
    "attach_predictions": attach_predictions,
    "encode_labels": encode_labels,
    "quarantine_labels": quarantine_labels,
    "label_remap": label_remap,
    "distribution": distribution,
    "languages": languages,
    "dataset_summary": dataset_summary,
    "shuffle": shuffle,
}

ORACLES = {
    "stratified_split": SPLIT_SQL,
    "split_by_origin": SPLIT_ORIGIN_SQL,
    "stratified_sample": SAMPLE_SQL,
    "cap_per_class": CAP_SQL,
    "class_deficit": f"WITH {DEFICIT_SQL} SELECT * FROM deficit",
    "resume_pending": PENDING_SQL,
    "merge_records": MERGE_SQL,
    "attach_predictions": f"""WITH {SCORED_SQL}
        SELECT record_id, label, pred, CAST(pred = label AS INTEGER) AS correct FROM scored""",
    "encode_labels": f"""WITH {RECORDS_SQL}, {CLASSES_SQL}
        SELECT record_id, r.label, idx AS label_idx FROM records r JOIN classes c ON c.label = r.label""",
    "quarantine_labels": "SELECT doc_id, lang AS label FROM documents WHERE lang NOT IN ('en', 'fr')",
    "label_remap": """SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE lang END AS label
        FROM documents""",
    "distribution": "SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1",
    "languages": "SELECT DISTINCT lang FROM documents",
    "dataset_summary": SUMMARY_SQL,
    "shuffle": SHUFFLE_SQL,
}

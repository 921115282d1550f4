"""Queries of the operators of this package over the test tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, quality, toxicity
from .ball_tree import top_inner_products
from .collocations import collocations
from .lexical import search
from .line_dedup import repeated_lines
from .mixing import mix
from .neighbours import nearest
from .ngram_join import jaccard_components
from .packing import pack_documents
from .pii import pii_spans
from .secret_scan import per_row, secret_spans
from .spans import span_text

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return toxicity.score(docs, model).withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, tables=2)


def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def _span_columns(kinds: list[str]) -> list[Column]:
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [
        "doc_id",
        *[count(kind) for kind in kinds],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    ]


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return per_row(docs, secret_spans(docs)).select(*_span_columns(["assign", "access", "hex"]))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER, decoded=True, tables=2)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out()), "quality", ("n_chars",))
    scored = quality.score(docs, model, ("n_chars",))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return per_row(docs, pii_spans(docs)).select(*_span_columns(["email", "ip", "card", "phone"]))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("times")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_nearest": op2_nearest,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_ball_tree": op5_ball_tree,
    "op6_secret_scan": op6_secret_scan,
    "op7_bpe": op7_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_lexical_search": op13_lexical_search,
}
_VECTORS = """v AS (
  SELECT vec_id, min({value}) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0{more}
  GROUP BY vec_id)"""
_PRODUCT = "list_reduce(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * c.x[i]), lambda a, b: a + b)"


def _search_sql(vectors: str, every: int, k: int, kind: str) -> str:
    return f"""WITH {vectors}, pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, {_PRODUCT} AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % {every} = 0), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS {kind}) AS score FROM ranked WHERE rank <= {k}"""


_TERMS = (
    "unnest(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
)
_LEXICAL_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, {_TERMS.format(text="text")} FROM d) GROUP BY r, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY r),
whole AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
m AS (SELECT r, 100 - 75 + (75 * n * documents) // terms AS m FROM sizes, whole),
b AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
q AS (SELECT i, term, count(*) AS times FROM (SELECT i, {_TERMS.format(text="text")} FROM b) GROUP BY i, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term), whole),
s AS (SELECT i, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY i, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM s JOIN b USING (i) JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
_COLLOCATION_SQL = """WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang HAVING sum(len(ws)) > 0),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS p
  FROM w, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(ws) >= k),
f AS (SELECT lang || chr(10) || p AS key, any_value(lang) AS lang, any_value(k) AS k, any_value(p) AS p, count(*) AS f FROM g GROUP BY key),
c AS (SELECT key, lang, k, p, string_split(p, ' ') AS ws, f AS a FROM f WHERE k > 1 AND f >= 30),
parts AS (SELECT key, a, cut, lang || chr(10) || array_to_string(ws[1:cut], ' ') AS head,
  lang || chr(10) || array_to_string(ws[cut + 1:], ' ') AS tail FROM c, (VALUES (1), (2), (3)) AS places(cut) WHERE cut < k),
cuts AS (SELECT parts.key, a, cut, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
  FROM parts JOIN f x ON x.key = head JOIN f y ON y.key = tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY key ORDER BY score, cut) = 1),
inside AS (SELECT lang || chr(10) || array_to_string(ws[i:i + m - 1], ' ') AS key, max(a) AS longer
  FROM c, (VALUES (2), (3)) AS sizes(m), (VALUES (1), (2), (3)) AS places(i) WHERE m < k AND i + m - 1 <= k GROUP BY 1),
kept AS (SELECT c.lang, c.p AS phrase, lowest.a, l, r, score FROM lowest JOIN c USING (key) LEFT JOIN inside USING (key)
  WHERE longer IS NULL OR 100 * longer < 80 * lowest.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM kept JOIN n USING (lang))
SELECT * FROM ranked WHERE rank <= 2000"""
ORACLES: dict[str, str] = {
    "op12_collocations": _COLLOCATION_SQL,
    "op13_lexical_search": _LEXICAL_SQL,
    "op2_nearest": _search_sql(
        _VECTORS.format(
            value="CAST(embedding AS DOUBLE[])", more=" AND len(list_filter(embedding, lambda c: c <> 0)) > 0"
        ), 20, 20, "DOUBLE"),
    "op5_ball_tree": _search_sql(
        _VECTORS.format(
            value="list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT))", more=""
        ), 50, 5, "BIGINT"),
}

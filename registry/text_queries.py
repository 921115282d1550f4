"""Text functions on the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import fixed_values as fv
from labelloom.functions import text as tx
from labelloom.functions.draws import draw, pick_literal
from labelloom.functions.ngrams import ngram_lists
from labelloom.operators.datasets import non_blank, with_text
from labelloom.operators.supervise import reply_examples

from .kit import (
    LINE_BREAK,
    SEED,
    SLOT,
    SPACE,
    quote,
    sql_byte_grams,
    sql_draw,
    sql_pick,
    sql_strip,
    sql_unit,
    sql_words,
    spread,
    table,
)

SLOTS = {"greet": ["hi", "hello", "hey"], "topic": ["spark", "sql"], "empty": []}
FILLERS = ["um", "so", "you know", "basically"]
ABBREVIATIONS = {"the": ["th", "d"], "and": ["n", "&"], "und": ["u"], "que": ["q", "k"], "des": ["d"]}
KEY = "doc_id"


def _slots():
    return F.create_map(
        *[x for k, v in SLOTS.items()
          for x in (F.lit(k), F.array(*[F.lit(i) for i in v]).cast("array<string>"))]
    )


def _abbreviations():
    return F.create_map(
        *[x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))]
    )


def _on_docs(make):
    """Query: doc_id and ``out`` = make(text, key) for every document."""

    def run(spark, sf_dir) -> DataFrame:
        docs = spread(spark, sf_dir, "documents")
        return docs.select(KEY, make(F.col("text"), F.col(KEY)).alias("out"))

    return run


def _sql_on_docs(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS out FROM documents"


def slot_fill(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    text = F.concat(F.lit("{greet} "), "text", F.lit(" {topic} {nothing}{empty}"))
    return docs.select(KEY, tx.fill_slots(text, _slots(), SEED, F.col(KEY)).alias("out"))


def _slot_case() -> str:
    cases = " ".join(
        f"WHEN {quote(k)} THEN {sql_pick(v, KEY, chr(39) + 'slot#' + chr(39) + ' || CAST(i - 1 AS VARCHAR)')}"
        for k, v in SLOTS.items() if v
    )
    return f"CASE names[i] {cases} ELSE '{{' || names[i] || '}}' END"


SLOT_SQL = f"""
WITH d AS (SELECT doc_id, '{{greet}} ' || text || ' {{topic}} {{nothing}}{{empty}}' AS t FROM documents),
s AS (SELECT doc_id, regexp_split_to_array(t, '{SLOT.replace('(', '(?:')}') AS parts,
             regexp_extract_all(t, '{SLOT}', 1) AS names FROM d)
SELECT doc_id, array_to_string(list_transform(parts,
  lambda p, i: p || CASE WHEN i <= len(names) THEN {_slot_case()} ELSE '' END), '') AS out
FROM s
"""


def filler_prefix(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    filler = pick_literal(FILLERS, draw(SEED, F.col(KEY), "prefix_filler"))
    filler = F.when(F.col("lang") == "en", filler)  # other languages have no fillers here
    return docs.select(KEY, tx.filler_prefix(F.col("text"), filler).alias("out"))


def filler_insert(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    filler = pick_literal(FILLERS, draw(SEED, F.col(KEY), "noise_filler"))
    filler = F.when(F.col("lang") == "en", filler)
    return docs.select(KEY, tx.filler_insert(F.col("text"), filler, SEED, F.col(KEY)).alias("out"))


FILLER_INSERT_SQL = f"""
WITH d AS (SELECT doc_id, text, lang, {sql_words('text')} AS ws FROM documents),
p AS (SELECT *, CAST({sql_draw(KEY, 'insert')} % (len(ws) + 1) AS INTEGER) AS pos,
             {sql_pick(FILLERS, KEY, 'noise_filler')} AS filler FROM d)
SELECT doc_id, CASE WHEN lang <> 'en' THEN text ELSE
  array_to_string(list_concat(list_concat(ws[1:pos], [filler]), ws[pos + 1:]), ' ') END AS out
FROM p
"""


def _abbr_case() -> str:
    idx = "CAST(i - 1 AS VARCHAR)"
    whens = " ".join(
        f"WHEN lower(w) = {quote(k)} AND {sql_unit(KEY, chr(39) + 'abbr#' + chr(39) + ' || ' + idx)} < CAST(0.05 AS DOUBLE)"
        f" THEN {sql_pick(v, KEY, chr(39) + 'abbr_pick#' + chr(39) + ' || ' + idx)}"
        for k, v in ABBREVIATIONS.items()
    )
    return f"CASE {whens} ELSE w END"


ABBREVIATE_SQL = f"""
WITH d AS (SELECT doc_id, {sql_words('text')} AS ws FROM documents)
SELECT doc_id, array_to_string(list_transform(ws, lambda w, i: {_abbr_case()}), ' ') AS out FROM d
"""

TYPO_SQL = f"""
WITH d AS (SELECT doc_id, text, {sql_words('text')} AS ws FROM documents),
c AS (SELECT *, list_filter(list_transform(ws, lambda w, i: CASE WHEN length(w) >= 4 THEN i END),
                            lambda i: i IS NOT NULL) AS cand FROM d),
t AS (SELECT *, CASE WHEN len(cand) > 0
        THEN cand[{sql_draw(KEY, 'typo_word')} % len(cand) + 1] END AS target FROM c),
w AS (SELECT *, ws[target] AS word,
        CASE WHEN target IS NOT NULL THEN {sql_draw(KEY, 'typo_pos')} % (length(ws[target]) - 1) END AS pos FROM t)
SELECT doc_id, CASE WHEN target IS NULL THEN text ELSE array_to_string(list_concat(list_concat(
    ws[1:target - 1],
    [substr(word, 1, pos) || substr(word, pos + 2, 1) || substr(word, pos + 1, 1) || substr(word, pos + 3)]),
    ws[target + 1:]), ' ') END AS out
FROM w
"""


def _replies(spark, sf_dir):
    """Whole documents as model replies: numbered, dashed, plain and blank lines."""
    docs = spread(spark, sf_dir, "documents")
    reply = F.concat(F.lit("1. "), "text", F.lit("\n\n- "), "text", F.lit("\r\n12. * "), "source", F.lit("\n  \n* 3. "), "lang")
    return docs.select("doc_id", "source", "lang", reply.alias("reply"))


REPLY_SQL = """'1. ' || text || chr(10) || chr(10) || '- ' || text || chr(13) || chr(10) || '12. * ' || source
  || chr(10) || '  ' || chr(10) || '* 3. ' || lang"""


def sql_lines(reply: str) -> str:
    line = f"regexp_replace({sql_strip('x')}, '^\\p{{Nd}}+\\.{SPACE}+', '')"
    line = f"regexp_replace({line}, '^[-*]{SPACE}+', '')"
    return (
        f"list_filter(list_transform(regexp_split_to_array({reply}, '{LINE_BREAK}'), lambda x: {line}), "
        "lambda y: y <> '')"
    )


def clean_lines(spark, sf_dir):
    return reply_examples(_replies(spark, sf_dir), [], "doc_id").withColumn("line_no", F.col("line_no").cast("bigint"))


CLEAN_SQL = f"""
WITH d AS (SELECT doc_id, {sql_lines(REPLY_SQL)} AS lines FROM documents)
SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line_no, unnest(lines) AS text FROM d
"""


def strip_fence(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit(" ```json\n"), "text", F.lit("\n ``` \nafter")))
        .when(kind == 1, F.concat(F.lit("```\n"), "text"))
        .otherwise(F.concat("text", F.lit("\n```")))
    )
    return docs.select("doc_id", tx.strip_fence(text).alias("out"))


FENCE_SQL = f"""
WITH d AS (SELECT doc_id, {sql_strip('''CASE doc_id % 3
    WHEN 0 THEN ' ```json' || chr(10) || text || chr(10) || ' ``` ' || chr(10) || 'after'
    WHEN 1 THEN '```' || chr(10) || text
    ELSE text || chr(10) || '```' END''')} AS raw FROM documents),
l AS (SELECT doc_id, raw, (regexp_split_to_array(raw, '{LINE_BREAK}'))[2:] AS body FROM d),
e AS (SELECT *, list_position(list_transform(body, lambda x: {sql_strip('x')}), '```') AS close FROM l)
SELECT doc_id, CASE WHEN starts_with(raw, '```')
  THEN array_to_string(CASE WHEN coalesce(close, 0) > 0 THEN body[1:close - 1] ELSE body END, chr(10))
  ELSE raw END AS out FROM e
"""


def byte_encode(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(tx.byte_encode(F.col("text")).cast("array<string>"), " ").alias("out"))


BYTE_SQL = """
WITH d AS (SELECT doc_id, rpad(substr(hex(encode(text)), 1, 1024), 1024, '0') AS h FROM documents)
SELECT doc_id, array_to_string(list_transform(range(512),
  lambda i: CAST(CAST(('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2)) AS INTEGER) AS VARCHAR)), ' ') AS out FROM d
"""


def byte_ngrams(spark, sf_dir):
    """Number of distinct n-gram buckets and the largest, for every document and size."""
    docs = spread(spark, sf_dir, "documents")
    feats = docs.select("doc_id", F.explode(ngram_lists(F.col("text"), fv.NGRAM_SIZES, 4096)).alias("bucket"))
    size = F.floor(F.col("bucket") / 4096) + 3
    return feats.groupBy("doc_id", size.cast("bigint").alias("n")).agg(
        F.count(F.lit(1)).alias("buckets"), F.max(F.col("bucket") % 4096).alias("top")
    )


NGRAM_SQL = f"""WITH {sql_byte_grams('documents', 'g', [3, 4, 5, 6], 'doc_id')}
SELECT doc_id, CAST(n AS BIGINT) AS n, count(DISTINCT v % 4096) AS buckets, max(v % 4096) AS top FROM g GROUP BY ALL
"""


def marker_replace(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    frame = F.lit("[INTENT_A], then [INTENT_B] and [INTENT_A]")
    out = tx.replace_marker(tx.replace_marker(frame, "[INTENT_A]", F.col("text")), "[INTENT_B]", F.col("source"))
    return docs.select("doc_id", out.alias("out"))


def non_blank_query(spark, sf_dir):
    """Blank out the texts without a label, then drop the blank ones."""
    docs = spread(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    text = F.when(F.col("quality").isNull(), F.lit(" \t\n ")).otherwise(F.col("text"))
    joined = docs.join(labels, "doc_id", "left").withColumn("text", text)
    return non_blank(joined).select("doc_id", tx.strip(F.col("text")).alias("out"))


def replace_text(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents")
    return with_text(docs, tx.strip(F.col("text"))).select("doc_id", "text", "original_text", "lang", "source")


_T = "regexp_replace(text, '[?.,! ]+\\z', '')"
QUERIES = {
    "slot_fill": slot_fill,
    "first_words": _on_docs(lambda t, k: tx.first_words(t, fv.FRAGMENT_SITUATION_WORDS)),
    "marker_replace": marker_replace,
    "to_question": _on_docs(lambda t, k: tx.to_question(t, SEED, k)),
    "to_passive": _on_docs(lambda t, k: tx.to_passive(t, SEED, k)),
    "filler_prefix": filler_prefix,
    "add_suffix": _on_docs(lambda t, k: tx.add_suffix(t, SEED, k)),
    "to_formal": _on_docs(lambda t, k: tx.to_formal(t, SEED, k)),
    "abbreviate": _on_docs(lambda t, k: tx.abbreviate(t, _abbreviations(), SEED, k)),
    "typo": _on_docs(lambda t, k: tx.typo(t, SEED, k)),
    "filler_insert": filler_insert,
    "clean_lines": clean_lines,
    "strip_fence": strip_fence,
    "byte_encode": byte_encode,
    "byte_ngrams": byte_ngrams,
    "token_count": _on_docs(lambda t, k: tx.token_count(t).cast("bigint")),
    "non_blank": non_blank_query,
    "replace_text": replace_text,
}

ORACLES = {
    "slot_fill": SLOT_SQL,
    "first_words": _sql_on_docs(f"array_to_string(({sql_words('text')})[1:15], ' ')"),
    "marker_replace": _sql_on_docs(
        "replace(replace('[INTENT_A], then [INTENT_B] and [INTENT_A]', '[INTENT_A]', text), '[INTENT_B]', source)"
    ),
    "to_question": _sql_on_docs(f"{sql_pick(fv.QUESTION_PREFIXES, KEY, 'question')} || {_T} || '?'"),
    "to_passive": _sql_on_docs(
        f"CASE WHEN {sql_unit(KEY, 'passive')} < CAST(0.5 AS DOUBLE) THEN {quote(fv.PASSIVE_BEFORE)} || text "
        f"ELSE text || {quote(fv.PASSIVE_AFTER)} END"
    ),
    "filler_prefix": _sql_on_docs(
        f"CASE WHEN lang = 'en' THEN {sql_pick(FILLERS, KEY, 'prefix_filler')} || ' ' || text ELSE text END"
    ),
    "add_suffix": _sql_on_docs(
        f"text || ' ' || {sql_pick(fv.SUFFIXES, KEY, 'suffix')}"
    ),
    "to_formal": _sql_on_docs(f"{sql_pick(fv.FORMAL_PREFIXES, KEY, 'formal')} || text"),
    "abbreviate": ABBREVIATE_SQL,
    "typo": TYPO_SQL,
    "filler_insert": FILLER_INSERT_SQL,
    "clean_lines": CLEAN_SQL,
    "strip_fence": FENCE_SQL,
    "byte_encode": BYTE_SQL,
    "byte_ngrams": NGRAM_SQL,
    "token_count": _sql_on_docs(f"len({sql_words('text')})"),
    "non_blank": f"""SELECT d.doc_id, {sql_strip('d.text')} AS out FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL AND {sql_strip('d.text')} <> ''""",
    "replace_text": f"""SELECT doc_id, {sql_strip('text')} AS text, text AS original_text, lang, source
        FROM documents""",
}

"""Shared inputs of the checked queries, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import fixed_values as fv
from labelloom.functions.draws import draw, pick_index
from labelloom.operators.scale import spread_scan

SEED = 42
SPACE, LINE_BREAK, SLOT = fv.SPACE, fv.LINE_BREAK, fv.SLOT
CLASSES = ["simple", "reasoning", "agentic"]
LANGS = ["en", "fr", "de", "es"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Like ``table``, for queries that work hard on every row."""
    df = table(spark, sf_dir, name)
    return spread_scan(df.select(*columns) if columns else df)


# --- SQL text helpers -----------------------------------------------------------------


def quote(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    def cell(v):
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(cell(x) for x in v) + "]"
        return str(v) if isinstance(v, (int, float)) else quote(v)

    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows) + ")"


def sql_draw(key: str, name: str, seed: int = SEED) -> str:
    """``name`` is a SQL expression when it holds ``||``, else plain text."""
    shown = f"({name})" if "||" in name else quote(name)
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR), {shown})), 1, 8)) AS BIGINT)"


def sql_unit(key: str, name: str, seed: int = SEED) -> str:
    return f"(CAST({sql_draw(key, name, seed)} AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


def sql_pick(items: list[str], key: str, name: str, seed: int = SEED) -> str:
    listed = "[" + ", ".join(quote(i) for i in items) + "]"
    return f"({listed})[{sql_draw(key, name, seed)} % {len(items)} + 1]"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+\\z', '', 'g')"


def sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda w: w <> '')"


def sql_byte_grams(source: str, out: str, sizes: list[int], columns: str) -> str:
    """CTE ``out``: ``columns`` (a key of ``source``), n and v, the number of every n-gram of the text's bytes."""
    bytes_of = "regexp_extract_all(hex(encode(text)), '..')"
    ahead = ", ".join(f"lead(b0, {k}) OVER p AS b{k}" for k in range(1, max(sizes)))

    def number(n: int) -> str:
        value = "b0"
        for k in range(1, n):
            value = f"({value} * 256 + b{k})"
        return value

    return f"""{out}_x AS (SELECT {columns}, unnest({bytes_of}) AS x, generate_subscripts({bytes_of}, 1) AS i FROM {source}),
{out}_b AS (SELECT {columns}, i, CAST('0x' || x AS BIGINT) AS b0 FROM {out}_x),
{out}_w AS (SELECT {columns}, b0, {ahead} FROM {out}_b WINDOW p AS (PARTITION BY {columns} ORDER BY i)),
{out}_n AS (SELECT {columns}, unnest([{', '.join(map(str, sizes))}]) AS n, unnest([{', '.join(map(number, sizes))}]) AS v FROM {out}_w),
{out} AS (SELECT * FROM {out}_n WHERE v IS NOT NULL)"""


def sql_weighted(pairs: list[tuple[str, float]], u: str) -> str:
    total, cases = 0.0, []
    for _, w in pairs:
        total += w
    edge = 0.0
    for v, w in pairs[:-1]:
        edge += w
        cases.append(f"WHEN {u} * CAST({total!r} AS DOUBLE) < CAST({edge!r} AS DOUBLE) THEN {quote(v)}")
    return f"CASE {' '.join(cases)} ELSE {quote(pairs[-1][0])} END"


# --- decorated requests -------------------------------------------------------------------
# The texts hold no question marks, fences or commands, so each gets one by doc_id.


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    text, kind = F.col("text"), F.col("doc_id") % 8
    nl = F.lit("\n")
    decorated = (
        F.when(kind == 0, F.concat(F.lit("/code "), text))
        .when(kind == 1, F.concat(text, F.lit("?")))
        .when(kind == 2, F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .when(kind == 3, F.concat("lang", nl, F.lit("    "), "source", nl, F.lit("    "), text))
        .when(kind == 4, F.concat(F.lit("fix "), text))
        .when(kind == 5, F.concat(F.lit("please refactor "), text))
        .when(kind == 6, F.concat(F.lit("How "), text))
        .otherwise(text)
    )
    return docs.select(F.col("doc_id").alias("request_id"), decorated.alias("text"), "lang", "source")


REQUESTS_SQL = """requests AS (
  SELECT doc_id AS request_id, lang, source,
    CASE doc_id % 8
      WHEN 0 THEN '/code ' || text
      WHEN 1 THEN text || '?'
      WHEN 2 THEN '```' || chr(10) || text || chr(10) || '```'
      WHEN 3 THEN lang || chr(10) || '    ' || source || chr(10) || '    ' || text
      WHEN 4 THEN 'fix ' || text
      WHEN 5 THEN 'please refactor ' || text
      WHEN 6 THEN 'How ' || text
      ELSE text END AS text
  FROM documents)"""


# --- synthetic labels and predictions ------------------------------------------------------


def _class_of(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CLASSES]), pick_index(number, len(CLASSES)) + 1)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as labelled records; the label is drawn, the language is the table's."""
    docs = table(spark, sf_dir, "documents")
    label = _class_of(draw(SEED, F.col("doc_id"), "label"))
    return docs.select(F.col("doc_id").alias("record_id"), "text", label.alias("label"), "lang", "source")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label, or in a fifth of the rows another class."""
    rows = records(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in CLASSES])
    own = F.array_position(names, F.col("label")).cast("int") - 1
    other = F.element_at(names, (own + 1 + pick_index(draw(SEED, F.col("record_id"), "other"), 2)) % 3 + 1)
    wrong = draw(SEED, F.col("record_id"), "pred") % 100 < 20
    return rows.select("record_id", F.when(wrong, other).otherwise(F.col("label")).alias("pred"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in CLASSES])
    own = F.array_position(names, F.col("label")).cast("int") - 1
    other = F.element_at(names, (own + 1 + pick_index(draw(SEED, F.col("record_id"), "other"), 2)) % 3 + 1)
    wrong = draw(SEED, F.col("record_id"), "pred") % 100 < 20
    return rows.withColumn("pred", F.when(wrong, other).otherwise(F.col("label")))


_NAMES = "[" + ", ".join(quote(c) for c in CLASSES) + "]"
RECORDS_SQL = f"""records AS (
  SELECT doc_id AS record_id, text, ({_NAMES})[{sql_draw('doc_id', 'label')} % 3 + 1] AS label, lang, source
  FROM documents)"""
SCORED_SQL = f"""{RECORDS_SQL}, scored AS (
  SELECT *, CASE WHEN {sql_draw('record_id', 'pred')} % 100 < 20
    THEN ({_NAMES})[(list_position({_NAMES}, label) + {sql_draw('record_id', 'other')} % 2) % 3 + 1]
    ELSE label END AS pred
  FROM records)"""
CLASSES_SQL = "classes(label, idx) AS " + values([(c, i) for i, c in enumerate(CLASSES)])

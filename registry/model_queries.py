"""Classifiers and user-function operators on the documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelloom.operators import classify as cf
from labelloom.operators import routing as rt
from labelloom.operators import supervise as sv
from labelloom.operators.datasets import classes_table, class_deficit, stratified_split

from .dataset_queries import DEFICIT_SQL, N_PER_CELL, task_records, wanted
from .kit import LANGS, REQUESTS_SQL, quote, requests, spread, sql_byte_grams, sql_draw, sql_strip, table, values
from .route_queries import LABELS, PREFIXES, _REST
from .text_queries import REPLY_SQL, _replies, sql_lines

SIZES, BUCKETS = [3, 4], 4096


def _records(spark, sf_dir):
    docs = spread(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return docs.select(F.col("doc_id").alias("record_id"), "text", F.col("lang").alias("label"))


def _split(spark, sf_dir):
    split = stratified_split(_records(spark, sf_dir))
    return split.filter("split = 'train'"), split.filter("split = 'val'")


def naive_bayes(spark, sf_dir):
    train, val = _split(spark, sf_dir)
    model = cf.train_naive_bayes(train, LANGS, SIZES, BUCKETS)
    out = model.predict(val)
    return out.select("record_id", "label", "pred", F.round(F.array_max("scores"), 6).alias("score"))


def logistic(spark, sf_dir):
    train, val = _split(spark, sf_dir)
    model = cf.train_logistic(train, val, classes_table(spark, LANGS), (0.01, 0.1), 10)
    return model.predict(val).select("record_id", "label", "pred", F.round("confidence", 6).alias("confidence"))


def predict_batches(spark, sf_dir):
    """A user's model, called with at most 128 texts at a time."""

    def model(texts):
        return ["long" if len(t) > 1000 else "short" for t in texts]

    return cf.predict_batches(_records(spark, sf_dir), model)


LABEL_MAP = [("en", "chat"), ("fr", "translate")]


def route_classifier(spark, sf_dir):
    """Native steps first; only the rows they leave are classified."""
    model = cf.train_naive_bayes(_records(spark, sf_dir), LANGS, [3], BUCKETS)
    mapping = spark.createDataFrame(LABEL_MAP, "from_label string, to_label string")
    steps = [
        rt.prefix(PREFIXES),
        rt.code_block(),
        rt.question(),
        rt.classifier(cf.unavailable, method="offline"),
        rt.classifier(cf.step_scorer(model.predict), mapping),
        rt.always(),
    ]
    out = rt.route(requests(spark, sf_dir), steps)
    return out.select("request_id", "label", "method", F.round("confidence", 6).alias("confidence"), "text", "error")


def _by_length(least: int, label: str):
    def score(df):
        return df.withColumns({"label": F.when(F.length("text") > least, label), "confidence": F.lit(0.5)})

    return score


def _two_classifiers():
    return [
        rt.prefix(PREFIXES),
        rt.question(),
        rt.classifier(_by_length(5000, "book"), method="first"),
        rt.classifier(_by_length(1000, "article"), method="second"),
        rt.always(),
    ]


def route_two_classifiers(spark, sf_dir):
    """Two classifier steps in a row: every request once, one scan."""
    out = rt.route(requests(spark, sf_dir), _two_classifiers())
    return out.select("request_id", "label", "method", "confidence", "error")


def route_explain_classifier(spark, sf_dir):
    rows = rt.explain(requests(spark, sf_dir), _two_classifiers())
    return rows.withColumn("step", F.col("step").cast("bigint"))


def logistic_facts(spark, sf_dir):
    """Validation rows per label, and whether every prediction is a class and the model is right in 9 of 10 rows."""
    right = (F.col("pred") == F.col("label")).cast("bigint")
    labels = logistic(spark, sf_dir).groupBy("label").agg(  # one pass over the texts; the rest is over one row per label
        F.count(F.lit(1)).alias("n"), F.sum(right).alias("right"), F.count(right).alias("seen"), F.min(F.col("pred").isin(*LANGS)).alias("known")
    )
    everywhere = Window.partitionBy()
    good = F.sum("right").over(everywhere) >= 0.9 * F.sum("seen").over(everywhere)
    return labels.select("label", "n", good.alias("good"), F.min("known").over(everywhere).alias("known"))


# --- prompts and user functions -----------------------------------------------------------

DESCRIPTIONS = {"en": "English prose", "fr": "French prose", "de": "German prose"}


def _deficit(spark, sf_dir):
    return class_deficit(task_records(spark, sf_dir), wanted(spark, sf_dir), N_PER_CELL, ["task_id", "label"])


def _prompts(spark, sf_dir):
    described = F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    prompt = sv.generation_prompt(
        F.col("label"), F.col("need"), F.concat(F.lit("texts of "), "task_id"),
        F.array(*[F.lit(x) for x in LANGS]), F.when(F.col("have") > 5, described).otherwise(none),
    )
    return _deficit(spark, sf_dir).select("task_id", "label", "need", prompt.alias("prompt"))


def catalog_prompt(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cells = docs.groupBy(F.col("source").alias("task_id"), F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    langs = F.array(*[F.lit(x) for x in LANGS])
    rows = cells.select(
        "task_id", "label", F.array_position(langs, F.col("label")).alias("idx"),
        F.concat(F.col("n").cast("string"), F.lit(" documents")).alias("description"), langs.alias("languages"),
    )
    return sv.catalog_prompt(rows, schema="{classes: {...}}")


def complete_stub(spark, sf_dir):
    def answer(prompt):
        head = prompt.split("\n")[0]
        if '"de"' in head:
            raise ValueError("no answer")
        return "1. " + head + "\n- " + prompt.split("\n")[-1]

    done = sv.complete(_prompts(spark, sf_dir), answer, partitions=4)
    return done.select("task_id", "label", "reply", "error")


def ingest_completions(spark, sf_dir):
    """Whole documents as replies; every class takes the lines it needs."""
    replies = _replies(spark, sf_dir).select(
        F.col("source").alias("task_id"), F.col("lang").alias("label"), F.col("doc_id").alias("completion_id"), "reply"
    )
    out = sv.ingest_completions(replies, _deficit(spark, sf_dir), ["task_id", "label"])
    return out.withColumn("line_no", F.col("line_no").cast("bigint"))


def _rephraser():
    class RateLimited(Exception):
        status_code = 429

    def fn(text):
        if text[:1] in ("E", "É"):
            raise ValueError("bad text")
        if text[:1] == "D":
            return ""
        if text[:1] == "A":
            raise RateLimited()
        return "  ~ " + text + "\n"

    return fn


def rephrase_stub(spark, sf_dir):
    return sv.rephrase(_records(spark, sf_dir), _rephraser(), wait_s=0.0)


def naturalize(spark, sf_dir):
    """A tenth of the documents by language, without those whose text has a label already."""
    rows = _records(spark, sf_dir)
    n = table(spark, sf_dir, "documents").count() // 10
    done = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    done = done.select(F.col("text").alias("original_text"))
    return sv.naturalize_rows(rows, _rephraser(), n, done=done, wait_s=0.0)


QUERIES = {
    "naive_bayes": naive_bayes,
    "logistic": logistic,
    "predict_batches": predict_batches,
    "route_classifier": route_classifier,
    "route_two_classifiers": route_two_classifiers,
    "route_explain_classifier": route_explain_classifier,
    "logistic_facts": logistic_facts,
    "gen_prompt": lambda s, d: _prompts(s, d),
    "catalog_prompt": catalog_prompt,
    "complete_stub": complete_stub,
    "ingest_completions": ingest_completions,
    "rephrase_stub": rephrase_stub,
    "naturalize": naturalize,
}

# --- SQL -----------------------------------------------------------------------------------

SPLIT_SQL = f"""k AS (SELECT doc_id AS record_id, text, lang AS label,
    row_number() OVER (PARTITION BY lang ORDER BY {sql_draw('doc_id', 'split')}, doc_id) AS rn,
    count(*) OVER (PARTITION BY lang) AS n FROM documents),
train AS (SELECT * FROM k WHERE rn > greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT))),
val AS (SELECT * FROM k WHERE rn <= greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)))"""


def _features_sql(source: str, out: str, sizes: list[int], columns: str) -> str:
    return f"""{sql_byte_grams(source, out + '_g', sizes, columns)},
{out} AS (SELECT DISTINCT {columns}, n, v % {BUCKETS} AS b FROM {out}_g)"""


def nb_sql(train: str, test: str, key: str, sizes: list[int]) -> str:
    """CTE ``nb``: key, label (predicted), score, confidence."""
    width = BUCKETS * len(sizes)
    return f"""{_features_sql(train, 'tf', sizes, 'label, ' + ('record_id' if train != test else key))},
{_features_sql(test, 'ef', sizes, key)},
cnt AS (SELECT label, n, b, count(*) AS c FROM tf GROUP BY ALL),
tot AS (SELECT t.label, count(*) AS rows, (SELECT sum(c) FROM cnt WHERE cnt.label = t.label) AS feats FROM {train} t GROUP BY t.label),
pri AS (SELECT label, ln(CAST(rows AS DOUBLE) / sum(rows) OVER ()) AS prior, ln(CAST(feats AS DOUBLE) + {width}) AS norm FROM tot),
hits AS (SELECT ef.{key}, p.label, p.prior, p.norm, count(*) AS nf,
    sum(ln(CAST(coalesce(cnt.c, 0) AS DOUBLE) + 1)) AS s
  FROM ef CROSS JOIN pri p LEFT JOIN cnt ON cnt.label = p.label AND cnt.n = ef.n AND cnt.b = ef.b GROUP BY ALL),
sc AS (SELECT {key}, label, s - nf * norm + prior AS score FROM hits),
nb AS (SELECT {key}, arg_max(label, score) AS label, max(score) AS score,
    1 / sum(exp(score - top)) AS confidence
  FROM (SELECT *, max(score) OVER (PARTITION BY {key}) AS top FROM sc) GROUP BY {key})"""


_NATIVE = ["prefix", "code_block", "question"]
_ROUTE_CLASSIFIER = f"""WITH {REQUESTS_SQL}, docs AS (SELECT doc_id AS record_id, text, lang AS label FROM documents),
{nb_sql('docs', 'requests', 'request_id', [3])},
t AS (SELECT *, {', '.join(f'{LABELS[m]} AS l_{m}' for m in _NATIVE)} FROM requests)
SELECT t.request_id,
  coalesce({', '.join('l_' + m for m in _NATIVE)},
    CASE nb.label WHEN 'en' THEN 'chat' WHEN 'fr' THEN 'translate' ELSE nb.label END) AS label,
  CASE {' '.join(f"WHEN l_{m} IS NOT NULL THEN '{m}'" for m in _NATIVE)} ELSE 'classifier' END AS method,
  CASE WHEN coalesce({', '.join('l_' + m for m in _NATIVE)}) IS NOT NULL THEN CAST(1 AS DOUBLE)
    ELSE round(nb.confidence, 6) END AS confidence,
  CASE WHEN l_prefix IS NOT NULL THEN {_REST} ELSE text END AS text, CAST(NULL AS VARCHAR) AS error
FROM t LEFT JOIN nb ON nb.request_id = t.request_id"""


def _named(skip_own: bool) -> str:
    parts = []
    for lang in LANGS:
        shown = f'"{lang}" ({DESCRIPTIONS[lang]})' if lang in DESCRIPTIONS else f'"{lang}"'
        parts.append(f"CASE WHEN {str(skip_own).lower()} AND label = '{lang}' THEN NULL ELSE {quote(shown)} END")
    return f"concat_ws(', ', {', '.join(parts)})"


_NL = "chr(10)"
_DESC = "CASE label " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in DESCRIPTIONS.items()) + " ELSE '' END"
_ALL = quote(", ".join(f'"{x}"' for x in LANGS))
PROMPT_SQL = f"""{DEFICIT_SQL}, prompts AS (SELECT task_id, label, need,
  'Generate ' || need || ' diverse, realistic examples for label "' || label || '".' || {_NL} ||
  'Task: texts of ' || task_id || {_NL} ||
  CASE WHEN have > 5 THEN 'Class definition: ' || {_DESC} || {_NL} || 'All labels: ' || {_named(False)} || {_NL} ||
    'Rules: one per line, plain text, no numbering, varied length.' || {_NL} ||
    'Focus on boundary cases — clearly "' || label || '", NOT: ' || {_named(True)}
  ELSE 'All labels: ' || {_ALL} || {_NL} ||
    'Rules: one per line, plain text, no numbering, varied length, clearly belongs to "' || label || '".' END
  || {_NL} || 'Output exactly ' || need || ' lines:' AS prompt FROM deficit)"""
_FIRST = "substr(text, 1, 1)"
_REPHRASED = f"""CASE WHEN {_FIRST} IN ('E', 'É', 'D', 'A') THEN text ELSE {sql_strip("'  ~ ' || text || chr(10)")} END AS text,
  text AS original_text, CASE WHEN {_FIRST} IN ('E', 'É') THEN 'ValueError: bad text'
    WHEN {_FIRST} = 'D' THEN 'empty reply' WHEN {_FIRST} = 'A' THEN 'rate limit' END AS error"""

_TWO = f"""t AS (SELECT *, {LABELS['prefix']} AS l0, {LABELS['question']} AS l1, CASE WHEN length(text) > 5000 THEN 'book' END AS l2,
  CASE WHEN length(text) > 1000 THEN 'article' END AS l3, 'default' AS l4 FROM requests)"""
_METHODS = ["prefix", "question", "first", "second", "always"]

ORACLES = {
    "route_two_classifiers": f"""WITH {REQUESTS_SQL}, {_TWO}
        SELECT request_id, coalesce(l0, l1, l2, l3, l4) AS label,
          CASE {' '.join(f"WHEN l{i} IS NOT NULL THEN '{m}'" for i, m in enumerate(_METHODS))} END AS method,
          CASE WHEN coalesce(l0, l1) IS NULL AND coalesce(l2, l3) IS NOT NULL THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS confidence,
          CAST(NULL AS VARCHAR) AS error FROM t""",
    "route_explain_classifier": f"""WITH {REQUESTS_SQL}, {_TWO},
        s AS (SELECT request_id, unnest(range(5)) AS step, unnest([{', '.join(quote(m) for m in _METHODS)}]) AS method,
          unnest([l0, l1, l2, l3, l4]) AS label FROM t),
        f AS (SELECT *, min(CASE WHEN label IS NOT NULL THEN step END) OVER (PARTITION BY request_id) AS first FROM s)
        SELECT request_id, step, method, label IS NOT NULL AS matched, label, first IS NULL OR step <= first AS reached FROM f""",
    "logistic_facts": f"""WITH {SPLIT_SQL} SELECT label, count(*) AS n, true AS good, true AS known FROM val GROUP BY label""",
    "naive_bayes": f"""WITH {SPLIT_SQL}, {nb_sql('train', 'val', 'record_id', SIZES)}
        SELECT val.record_id, val.label, nb.label AS pred, round(nb.score, 6) AS score
        FROM val JOIN nb ON nb.record_id = val.record_id""",
    "predict_batches": """SELECT doc_id AS record_id, CASE WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS pred
        FROM documents""",
    "route_classifier": _ROUTE_CLASSIFIER,
    "gen_prompt": f"WITH {PROMPT_SQL} SELECT task_id, label, need, prompt FROM prompts",
    "catalog_prompt": f"""WITH c AS (SELECT source AS task_id, lang AS label, count(*) AS n FROM documents GROUP BY ALL)
        SELECT task_id, 'Write a template catalogue as one JSON object.' || chr(10) || 'Classes:' || chr(10) ||
          string_agg('- **' || label || '**: ' || n || ' documents', chr(10)
            ORDER BY list_position([{', '.join(quote(x) for x in LANGS)}], label)) || chr(10) ||
          'Languages: {', '.join(LANGS)}' || chr(10) || 'Follow this schema:' || chr(10) || '{{classes: {{...}}}}' AS prompt
        FROM c GROUP BY task_id""",
    "complete_stub": f"""WITH {PROMPT_SQL} SELECT task_id, label,
        CASE WHEN label <> 'de' THEN '1. ' || string_split(prompt, chr(10))[1] || chr(10) || '- ' || string_split(prompt, chr(10))[-1] END AS reply,
        CASE WHEN label = 'de' THEN 'ValueError: no answer' END AS error FROM prompts""",
    "ingest_completions": f"""WITH {DEFICIT_SQL},
        l AS (SELECT source AS task_id, lang AS label, doc_id AS completion_id, {sql_lines(REPLY_SQL)} AS lines FROM documents),
        u AS (SELECT task_id, label, completion_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line_no,
          unnest(lines) AS text FROM l),
        k AS (SELECT u.*, need, row_number() OVER (PARTITION BY u.task_id, u.label ORDER BY completion_id, line_no) AS rn
          FROM u JOIN deficit d ON d.task_id = u.task_id AND d.label = u.label)
        SELECT task_id, label, completion_id, line_no, text FROM k WHERE rn <= need""",
    "rephrase_stub": f"SELECT doc_id AS record_id, lang AS label, {_REPHRASED} FROM documents",
    "naturalize": f"""WITH n AS (SELECT count(*) // 10 AS n FROM documents),
        l AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS k FROM (SELECT DISTINCT lang FROM documents)),
        q AS (SELECT lang, n // k + CASE WHEN i < n % k THEN 1 ELSE 0 END AS quota FROM l, n),
        r AS (SELECT d.*, quota, row_number() OVER (PARTITION BY d.lang ORDER BY {sql_draw('doc_id', 'sample', 99)}, doc_id) AS rn
          FROM documents d JOIN q ON q.lang = d.lang),
        s AS (SELECT * FROM r WHERE rn <= quota AND text NOT IN
          (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)))
        SELECT doc_id AS record_id, lang AS label, {_REPHRASED} FROM s""",
}

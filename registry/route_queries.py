"""Routing on decorated documents, backend health on events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from labelloom import fixed_values as fv
from labelloom.operators import health as hl
from labelloom.operators import language as lg
from labelloom.operators import routing as rt
from labelloom.session import STATE_STORE, ensure_checkpoint_dir
from labelloom.streaming import streams

from .kit import REQUESTS_SQL, SPACE, quote, requests, sql_words, table, values

PREFIXES = [("/code", "code"), ("/search", "research"), ("/edit", "edit")]
PATTERNS = [("(?i)^(fix|debug|error)", "code"), ("(?i)^(le|la|les) ", "translate"), (r"https?://\S+", "research")]
KEYWORDS = [(["refactor", "rewrite", "clean up"], "edit"), (["und", "der"], "translate"), (["estion", "thand"], "research")]
ALL_WORDS = [(["und", "der", "des"], "german"), (["que", "de la"], "romance"), (["The", "and"], "english")]
LENGTHS = [{"max": 800, "label": "chat"}, {"min": 801, "max": 3000, "label": "edit"}]
TOKENS = [{"max": 20, "label": "chat"}, {"min": 500, "label": "research"}, {"max": 200, "label": "edit"}]
MIN_CONFIDENCE = 0.98
ROUTES = [
    ("code", ["b1", "b0"]), ("edit", ["b0"]), ("chat", ["b2", "b1", "b0"]), ("research", ["b1"]),
    ("default", ["b0", "b2"]), ("english", ["b2"]),
]
TTL_S = 600
DELAY_S = 10


def native_steps():
    return [
        rt.prefix(PREFIXES),
        rt.code_block(),
        rt.question(),
        rt.regex(PATTERNS),
        rt.keyword(KEYWORDS),
        rt.language("translate", None, MIN_CONFIDENCE),
        rt.length(LENGTHS),
        rt.always(),
    ]


def _single(step):
    """One step alone: unmatched rows carry the error."""

    def run(spark, sf_dir):
        out = rt.route(requests(spark, sf_dir), [step])
        return out.select("request_id", "label", "method", F.round("confidence", 9).alias("confidence"), "text", "error")

    return run


def _routed(spark, sf_dir):
    return rt.route(requests(spark, sf_dir), native_steps())


def route_first_match(spark, sf_dir):
    """All native steps in order; the context columns pass through."""
    return _routed(spark, sf_dir).select(
        "request_id", "label", "method", F.round("confidence", 9).alias("confidence"), "text", "lang", "source", "error"
    )


def route_explain(spark, sf_dir):
    rows = rt.explain(requests(spark, sf_dir), native_steps())
    return rows.withColumn("step", F.col("step").cast("bigint"))


def _custom_step():
    def shouting(text):
        n = F.length(text)
        share = F.try_divide(F.length(F.regexp_replace(text, r"\P{Lu}+", "")), n)
        share = F.when(n == 0, F.lit(float("nan"))).otherwise(share)  # as the SQL, in which 0 / 0 is a NaN and more than any number
        return F.when(share > 0.02, F.struct(F.lit("loud").alias("label"), F.lit(0.5).alias("confidence"), text.alias("text")))

    return rt.custom("shouting", shouting)


def _parts(spark, sf_dir):
    """Documents to learn from, and held-out ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.filter("doc_id % 3 <> 1"), docs.filter("doc_id % 3 = 1")


def language_profiles(spark, sf_dir):
    return lg.gram_ranks(_parts(spark, sf_dir)[0])


def _languages_found(spark, sf_dir):
    learn, rest = _parts(spark, sf_dir)
    return lg.train_profiles(learn).scores(rest)


def language_scores(spark, sf_dir):
    found = _languages_found(spark, sf_dir)
    return found.select("doc_id", "lang_pred", F.round("lang_confidence", 9).alias("confidence"))


def language_accuracy(spark, sf_dir):
    """Held-out documents per language, and how many of them are recognised."""
    found = _languages_found(spark, sf_dir)
    right = F.sum(F.coalesce(F.col("lang_pred") == F.col("lang"), F.lit(False)).cast("bigint"))
    return found.groupBy("lang").agg(F.count("*").alias("n"), right.alias("correct"), (right >= 0.95 * F.count("*")).alias("good"))


def route_language_profiles(spark, sf_dir):
    """Spanish, French and German texts by profiles, which no share of letters could tell from English."""
    profiles = lg.train_profiles(_parts(spark, sf_dir)[0])
    steps = [rt.prefix(PREFIXES), lg.language_by_profiles(profiles, "translate", None, 0.05), rt.always()]
    out = rt.route(requests(spark, sf_dir), steps)
    return out.select("request_id", "label", "method", F.round("confidence", 9).alias("confidence"), "error")


# --- health ---------------------------------------------------------------------------
# Errors and sign-ups are checks (down, up); every other event is a request.


def _backend():
    return F.concat(F.lit("b"), (F.col("user_id") % 3).cast("string")).alias("backend")


def _checks_of(events):
    checks = events.filter(F.col("event_type").isin("error", "signup"))
    return checks.select(_backend(), F.col("ts").alias("checked_at"), (F.col("event_type") == "signup").alias("up"))


def _requests_of(events):
    asked = events.filter(~F.col("event_type").isin("error", "signup"))
    return asked.select(F.col("event_id").alias("request_id"), F.col("ts"), "event_type", _backend())


def _health(spark, sf_dir):
    return _checks_of(table(spark, sf_dir, "events"))


def _asked(spark, sf_dir):
    return _requests_of(table(spark, sf_dir, "events"))


def _now(spark, sf_dir):
    """The time of the last event, as a column."""
    last = table(spark, sf_dir, "events").agg(F.max("ts").cast("string")).first()[0]
    return F.lit(last).cast("timestamp")


def health_asof(spark, sf_dir):
    asked = _asked(spark, sf_dir).drop("event_type")
    # a small task size, so that the salted path runs as well
    found = hl.health_asof(asked, _health(spark, sf_dir), TTL_S, rows_per_task=2)
    age = F.unix_micros("ts") - F.unix_micros("checked_at")
    return found.select("request_id", "backend", age.alias("age_us"), "up")


def backend_status(spark, sf_dir):
    now = _now(spark, sf_dir)
    status = hl.backend_status(_health(spark, sf_dir), now, TTL_S)
    age = F.unix_micros(now) - F.unix_micros("checked_at")
    return status.select("backend", age.alias("age_us"), "fresh", "up", "status")


def _routes(spark):
    return spark.createDataFrame(ROUTES, "label string, backends array<string>")


def route_fallback(spark, sf_dir):
    status = hl.backend_status(_health(spark, sf_dir), _now(spark, sf_dir), 24 * 3600)
    out = hl.resolve_backends(_routed(spark, sf_dir), _routes(spark), status)
    return out.select("request_id", "label", "backend", "fallback_used", "error")


def _decided(asked):
    labels = {"view": "chat", "click": "code", "purchase": "nowhere"}
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[F.col("event_type")]
    return asked.select("request_id", "ts", label.alias("label"), F.lit(None).cast("string").alias("error"))


def _asof_decisions(spark, sf_dir):
    return _decided(_asked(spark, sf_dir))


def route_fallback_asof(spark, sf_dir):
    out = hl.resolve_backends_asof(_asof_decisions(spark, sf_dir), _routes(spark), _health(spark, sf_dir), TTL_S)
    return out.select("request_id", "label", "backend", "fallback_used", "error")


def _asof_by_row(spark, sf_dir, request_id):
    decisions = _asof_decisions(spark, sf_dir).withColumn("request_id", request_id)
    out = hl.resolve_backends_asof(decisions, _routes(spark), _health(spark, sf_dir), TTL_S, rows_per_task=50)
    return out.select("request_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "label", "backend", "fallback_used", "error")


def route_fallback_asof_repeated(spark, sf_dir):
    """Many requests share an id; each is resolved at its own time."""
    return _asof_by_row(spark, sf_dir, F.col("request_id") % 50)


def route_fallback_asof_null_ids(spark, sf_dir):
    return _asof_by_row(spark, sf_dir, F.when(F.col("request_id") % 3 != 0, F.col("request_id")))


def route_stream_asof(spark, sf_dir):
    """The same decisions from streams of requests and checks: all whose times the watermark has passed at the end."""
    own = spark.newSession()  # the state store is a setting of the session
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/route_stream_asof-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    events = own.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")  # a pattern: the table may be one file
    found = streams.resolve_stream_asof(
        _decided(_requests_of(events)), _checks_of(events), own.createDataFrame(ROUTES, "label string, backends array<string>"), TTL_S, DELAY_S
    )
    found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(
        availableNow=True
    ).start().awaitTermination()
    out = spark.read.schema(found.schema).parquet(f"{folder}/out")
    return out.select("request_id", "label", "backend", "fallback_used", "error")


def route_default(spark, sf_dir):
    """Labels without a route use the default one."""
    status = hl.backend_status(_health(spark, sf_dir), _now(spark, sf_dir), 24 * 3600)
    out = hl.resolve_backends(_routed(spark, sf_dir), _routes(spark), status, default_route="default")
    return out.select("request_id", "label", "backend", "fallback_used", "error")


def decision_mix(spark, sf_dir):
    status = hl.backend_status(_health(spark, sf_dir), _now(spark, sf_dir), 24 * 3600)
    return rt.decision_mix(hl.resolve_backends(_routed(spark, sf_dir), _routes(spark), status))


QUERIES = {
    "route_prefix": _single(rt.prefix(PREFIXES)),
    "route_code_block": _single(rt.code_block()),
    "route_question": _single(rt.question()),
    "route_regex": _single(rt.regex(PATTERNS)),
    "route_keyword": _single(rt.keyword(KEYWORDS)),
    "route_keyword_all": _single(rt.keyword(ALL_WORDS, case_sensitive=True, match="all")),
    "route_keyword_substring": _single(rt.keyword(ALL_WORDS, match_mode="substring")),
    "route_language": _single(rt.language("translate", "english", MIN_CONFIDENCE)),
    "route_language_column": _single(rt.language("translate", None, 0.5, lang_col="lang")),
    "route_length": _single(rt.length(LENGTHS)),
    "route_tokens": _single(rt.length(TOKENS, unit="tokens")),
    "route_custom": _single(_custom_step()),
    "route_first_match": route_first_match,
    "route_explain": route_explain,
    "route_fallback": route_fallback,
    "route_fallback_asof": route_fallback_asof,
    "language_profiles": language_profiles,
    "language_scores": language_scores,
    "language_accuracy": language_accuracy,
    "route_language_profiles": route_language_profiles,
    "route_fallback_asof_repeated": route_fallback_asof_repeated,
    "route_fallback_asof_null_ids": route_fallback_asof_null_ids,
    "route_stream_asof": route_stream_asof,
    "route_default": route_default,
    "decision_mix": decision_mix,
    "health_asof": health_asof,
    "backend_status": backend_status,
}

# --- SQL ---------------------------------------------------------------------------------

_EDGE = r"[^\p{L}\p{N}_]"


def _has(words: list[str], fold: bool = True) -> str:
    flags = "(?i)" if fold else ""
    return f"regexp_matches(text, '{flags}(?:^|{_EDGE})(?:{'|'.join(words)})(?:{_EDGE}|\\z)')"


def _case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {quote(label)}" for cond, label in rules) + " END"


_QUESTION = "|".join(fv.QUESTION_WORDS)
_LETTERS = r"regexp_replace(text, '\P{L}+', '', 'g')"
_SHARE = (
    rf"(CAST(length(regexp_replace({_LETTERS}, '[^A-Za-z]+', '', 'g')) AS DOUBLE) / nullif(length({_LETTERS}), 0))"
)
LABELS = {
    "prefix": _case([(f"starts_with(text, {quote(p)})", label) for p, label in PREFIXES]),
    "code_block": _case([("regexp_matches(text, '(?s)```.*```') OR regexp_matches(text, '(?:^|\\n) {4}[^\\n]*\\n {4}')", "code")]),
    "question": _case([(f"regexp_matches(text, '\\?{SPACE}*\\z') OR regexp_matches(text, '(?i)^(?:{_QUESTION})(?:{_EDGE}|\\z)')", "chat")]),
    "regex": _case([(f"regexp_matches(text, {quote(p)})", label) for p, label in PATTERNS]),
    "keyword": _case([(_has(words), label) for words, label in KEYWORDS]),
    "language": _case([(f"{_SHARE} < CAST({MIN_CONFIDENCE} AS DOUBLE)", "translate")]),
    "length": _case([("length(text) <= 800", "chat"), ("length(text) BETWEEN 801 AND 3000", "edit")]),
    "always": "'default'",
}
_REST = f"regexp_replace(substr(text, CASE WHEN starts_with(text, '/search') THEN 8 ELSE 6 END), '^{SPACE}+', '')"


def _single_sql(method: str, label: str, confidence: str = "CAST(1 AS DOUBLE)", text: str = "text") -> str:
    return f"""WITH {REQUESTS_SQL}, m AS (SELECT *, {label} AS label, {confidence} AS conf FROM requests)
    SELECT request_id, label, CASE WHEN label IS NOT NULL THEN '{method}' END AS method,
      CASE WHEN label IS NOT NULL THEN round(conf, 9) END AS confidence,
      CASE WHEN label IS NOT NULL THEN {text} ELSE text END AS text,
      CASE WHEN label IS NULL THEN 'pipeline_exhausted' END AS error FROM m"""


_TRIES = ", ".join(f"{expr} AS l_{name}" for name, expr in LABELS.items())
ROUTED_SQL = f"""{REQUESTS_SQL}, tries AS (SELECT *, {_TRIES}, {_SHARE} AS ascii_share FROM requests),
routed AS (SELECT request_id, lang, source,
  coalesce({', '.join('l_' + name for name in LABELS)}) AS label,
  CASE {' '.join(f"WHEN l_{name} IS NOT NULL THEN '{name}'" for name in LABELS)} END AS method,
  ascii_share, CASE WHEN l_prefix IS NOT NULL THEN {_REST} ELSE text END AS text
  FROM tries)"""

HEALTH_SQL = """health AS (SELECT 'b' || CAST(user_id % 3 AS VARCHAR) AS backend, ts AS checked_at,
    event_type = 'signup' AS up FROM events WHERE event_type IN ('error', 'signup')),
asked AS (SELECT event_id AS request_id, ts, event_type, 'b' || CAST(user_id % 3 AS VARCHAR) AS backend
  FROM events WHERE event_type NOT IN ('error', 'signup'))"""


def _status_sql(ttl: int) -> str:
    return f"""{HEALTH_SQL}, now AS (SELECT max(ts) AS now FROM events),
last AS (SELECT backend, max(checked_at) AS checked_at, arg_max(up, checked_at) AS last_up FROM health GROUP BY backend),
status AS (SELECT backend, checked_at, checked_at >= now - INTERVAL {ttl} SECOND AS fresh,
  CASE WHEN checked_at >= now - INTERVAL {ttl} SECOND THEN last_up ELSE true END AS up FROM last, now)"""


ROUTES_SQL = f"routes(label, backends) AS {values(ROUTES)}"
_CHAIN = """chain AS (SELECT label, unnest(backends) AS backend, unnest(range(len(backends))) AS pos FROM routes)"""
_RESOLVED = f"""{ROUTES_SQL}, {_CHAIN},
best AS (SELECT c.label, arg_min(c.backend, pos) FILTER (coalesce(up, true)) AS backend,
  min(pos) FILTER (coalesce(up, true)) AS pos FROM chain c LEFT JOIN status s ON s.backend = c.backend GROUP BY c.label)"""


def _fallback_sql(wanted: str) -> str:
    return f"""resolved AS (SELECT r.*, b.backend, coalesce(b.pos > 0, false) AS fallback_used,
  CASE WHEN b.label IS NULL THEN 'unknown_route' WHEN b.backend IS NULL THEN 'no_backends_available' END AS error
  FROM routed r LEFT JOIN best b ON b.label = {wanted})"""


_KNOWN = "CASE WHEN r.label IN (SELECT label FROM routes) THEN r.label ELSE 'default' END"
_DAY = 24 * 3600
_ASOF_FRESH = f"h.checked_at >= a.ts - INTERVAL {TTL_S} SECOND"

_ASOF_SQL = f"""{HEALTH_SQL}, {ROUTES_SQL}, {_CHAIN},
d AS (SELECT request_id, ts, CASE event_type WHEN 'view' THEN 'chat' WHEN 'click' THEN 'code' ELSE 'nowhere' END AS label FROM asked),
t AS (SELECT d.request_id, d.ts, c.pos, c.backend FROM d JOIN chain c ON c.label = d.label),
a AS (SELECT a.request_id, a.pos, a.backend, CASE WHEN {_ASOF_FRESH} THEN h.up ELSE true END AS up
  FROM t a ASOF LEFT JOIN health h ON h.backend = a.backend AND a.ts >= h.checked_at),
b AS (SELECT request_id, arg_min(backend, pos) FILTER (up) AS backend, min(pos) FILTER (up) AS pos FROM a GROUP BY request_id),
resolved AS (SELECT d.request_id, d.ts, d.label, b.backend, coalesce(b.pos > 0, false) AS fallback_used,
  CASE WHEN d.label NOT IN (SELECT label FROM routes) THEN 'unknown_route' WHEN b.backend IS NULL THEN 'no_backends_available' END AS error
  FROM d LEFT JOIN b ON b.request_id = d.request_id)"""

def _grams_sql(source: str, columns: str) -> str:
    return f"""SELECT {columns}, unnest(list_transform(generate_series(1, len(c) - k + 1), lambda i:
    CASE k WHEN 1 THEN c[i] WHEN 2 THEN c[i] || c[i + 1] ELSE c[i] || c[i + 1] || c[i + 2] END)) AS gram
  FROM (SELECT *, regexp_extract_all(lower(text), '(?s).') AS c FROM {source}), (VALUES (1), (2), (3)) AS sizes(k) WHERE len(c) >= k"""


_PROFILES_SQL = f"""learn AS (SELECT * FROM documents WHERE doc_id % 3 <> 1),
counted AS (SELECT lang, gram, count(*) AS n FROM ({_grams_sql('learn', 'lang')}) GROUP BY lang, gram),
profiles AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS rank, gram, n FROM counted QUALIFY rank < 300)"""


def _language_sql(source: str, key: str) -> str:
    return f"""{_PROFILES_SQL}, asked AS (SELECT DISTINCT {key}, gram FROM ({_grams_sql(source, key)})),
points AS (SELECT {key}, p.lang, sum(300 - rank) AS points FROM asked JOIN profiles p USING (gram) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY points DESC, lang) AS place FROM points),
best AS (SELECT {key}, max(lang) FILTER (place = 1) AS lang_pred, coalesce((max(points) FILTER (place = 1)
  - coalesce(max(points) FILTER (place = 2), 0)) / CAST(max(points) FILTER (place = 1) AS DOUBLE), 0) AS confidence FROM placed GROUP BY {key}),
found AS (SELECT s.*, b.lang_pred, coalesce(b.confidence, 0) AS margin FROM {source} s LEFT JOIN best b USING ({key}))"""


ORACLES = {
    "language_profiles": f"WITH {_PROFILES_SQL} SELECT lang, CAST(rank AS BIGINT) AS rank, gram, n FROM profiles",
    "language_scores": f"""WITH rest AS (SELECT * FROM documents WHERE doc_id % 3 = 1), {_language_sql('rest', 'doc_id')}
        SELECT doc_id, lang_pred, round(margin, 9) AS confidence FROM found""",
    "language_accuracy": f"""WITH rest AS (SELECT * FROM documents WHERE doc_id % 3 = 1), {_language_sql('rest', 'doc_id')},
        c AS (SELECT lang, count(*) AS n, CAST(coalesce(sum(CAST(lang_pred = lang AS BIGINT)), 0) AS BIGINT) AS correct FROM found GROUP BY lang)
        SELECT *, correct >= CAST(0.95 AS DOUBLE) * n AS good FROM c""",
    "route_language_profiles": f"""WITH {REQUESTS_SQL}, {_language_sql('requests', 'request_id')},
        r AS (SELECT *, {LABELS["prefix"]} AS pre, margin >= CAST(0.05 AS DOUBLE) AND lang_pred <> 'en' AS foreign_text FROM found)
        SELECT request_id, CASE WHEN pre IS NOT NULL THEN pre WHEN foreign_text THEN 'translate' ELSE 'default' END AS label,
          CASE WHEN pre IS NOT NULL THEN 'prefix' WHEN foreign_text THEN 'language' ELSE 'always' END AS method,
          CASE WHEN pre IS NULL AND foreign_text THEN round(margin, 9) ELSE CAST(1 AS DOUBLE) END AS confidence, CAST(NULL AS VARCHAR) AS error FROM r""",
    "route_prefix": _single_sql("prefix", LABELS["prefix"], text=_REST),
    "route_code_block": _single_sql("code_block", LABELS["code_block"]),
    "route_question": _single_sql("question", LABELS["question"]),
    "route_regex": _single_sql("regex", LABELS["regex"]),
    "route_keyword": _single_sql("keyword", LABELS["keyword"]),
    "route_keyword_all": _single_sql(
        "keyword", _case([(" AND ".join(_has([w], False) for w in words), label) for words, label in ALL_WORDS])
    ),
    "route_keyword_substring": _single_sql(
        "keyword",
        _case([(" OR ".join(f"contains(lower(text), {quote(w.lower())})" for w in words), label) for words, label in ALL_WORDS]),
    ),
    "route_language": _single_sql(
        "language",
        _case([(f"{_SHARE} < CAST({MIN_CONFIDENCE} AS DOUBLE)", "translate"), (f"{_SHARE} >= CAST({MIN_CONFIDENCE} AS DOUBLE)", "english")]),
        _SHARE,
    ),
    "route_language_column": _single_sql("language", _case([("lang <> 'en'", "translate")])),
    "route_length": _single_sql("length", LABELS["length"]),
    "route_tokens": _single_sql(
        "length",
        _case([(f"len({sql_words('text')}) <= 20", "chat"), (f"len({sql_words('text')}) >= 500", "research"),
               (f"len({sql_words('text')}) <= 200", "edit")]),
    ),
    "route_custom": _single_sql(
        "shouting",
        r"CASE WHEN CAST(length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS DOUBLE) / length(text) > CAST(0.02 AS DOUBLE) THEN 'loud' END",
        "CAST(0.5 AS DOUBLE)",
    ),
    "route_first_match": f"""WITH {ROUTED_SQL} SELECT request_id, label, method,
        round(CASE WHEN method = 'language' THEN ascii_share ELSE CAST(1 AS DOUBLE) END, 9) AS confidence,
        text, lang, source, CAST(NULL AS VARCHAR) AS error FROM routed""",
    "route_explain": f"""WITH {ROUTED_SQL.split(', tries AS')[0]}, tries AS (SELECT *, {_TRIES} FROM requests),
        s AS (SELECT request_id, unnest(range({len(LABELS)})) AS step,
          unnest([{', '.join(quote(n) for n in LABELS)}]) AS method,
          unnest([{', '.join('l_' + n for n in LABELS)}]) AS label FROM tries),
        f AS (SELECT *, min(CASE WHEN label IS NOT NULL THEN step END) OVER (PARTITION BY request_id) AS first FROM s)
        SELECT request_id, step, method, label IS NOT NULL AS matched, label, first IS NULL OR step <= first AS reached FROM f""",
    "route_fallback": f"""WITH {ROUTED_SQL}, {_status_sql(_DAY)}, {_RESOLVED}, {_fallback_sql('r.label')}
        SELECT request_id, label, backend, fallback_used, error FROM resolved""",
    "route_default": f"""WITH {ROUTED_SQL}, {_status_sql(_DAY)}, {_RESOLVED}, {_fallback_sql(_KNOWN)}
        SELECT request_id, label, backend, fallback_used, error FROM resolved""",
    "route_fallback_asof": f"""WITH {_ASOF_SQL}
        SELECT request_id, label, backend, fallback_used, error FROM resolved""",
    "route_fallback_asof_repeated": f"""WITH {_ASOF_SQL}
        SELECT request_id % 50 AS request_id, epoch_us(ts) AS ts_us, label, backend, fallback_used, error FROM resolved""",
    "route_fallback_asof_null_ids": f"""WITH {_ASOF_SQL}
        SELECT CASE WHEN request_id % 3 <> 0 THEN request_id END AS request_id, epoch_us(ts) AS ts_us, label, backend, fallback_used, error
        FROM resolved""",
    "route_stream_asof": f"""WITH {_ASOF_SQL}, seen AS (SELECT ts AS moment FROM d UNION ALL
          SELECT checked_at FROM health WHERE backend IN (SELECT backend FROM chain)),
        passed AS (SELECT epoch_us(max(moment)) // 1000 - {DELAY_S * 1000} AS ms FROM seen)
        SELECT request_id, label, backend, fallback_used, error FROM resolved, passed
        WHERE error = 'unknown_route' OR (epoch_us(ts) + 999) // 1000 <= ms""",
    "decision_mix": f"""WITH {ROUTED_SQL}, {_status_sql(_DAY)}, {_RESOLVED}, {_fallback_sql('r.label')}
        SELECT method, label, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share,
          CAST(sum(CAST(fallback_used AS BIGINT)) AS DOUBLE) / count(*) AS fallback_rate
        FROM resolved GROUP BY method, label""",
    "health_asof": f"""WITH {HEALTH_SQL}
        SELECT request_id, a.backend, CASE WHEN {_ASOF_FRESH} THEN epoch_us(a.ts) - epoch_us(h.checked_at) END AS age_us,
          CASE WHEN {_ASOF_FRESH} THEN h.up ELSE true END AS up
        FROM asked a ASOF LEFT JOIN health h ON h.backend = a.backend AND a.ts >= h.checked_at""",
    "backend_status": f"""WITH {_status_sql(TTL_S)} SELECT backend, epoch_us(now) - epoch_us(checked_at) AS age_us, fresh, up,
        CASE WHEN up THEN 'up' ELSE 'down' END AS status FROM status, now""",
}

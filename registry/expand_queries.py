"""Catalogue and expansion queries: one expanded record per order, or augmented documents."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import functions as F

from labelloom import fixed_values as fv
from labelloom.functions.draws import draw
from labelloom.operators import expand as ex
from labelloom.operators.scale import spread_scan
from labelloom.sources import catalog as cl

from .demo_catalog import DEMO, LANGUAGES
from .kit import (
    CLASSES,
    RECORDS_SQL,
    SEED,
    SLOT,
    quote,
    records,
    spread,
    sql_draw,
    sql_pick,
    sql_unit,
    sql_weighted,
    sql_words,
    values,
)

TYPES = fv.CONV_TYPES


@lru_cache(maxsize=2)
def _catalog(spark):
    return cl.catalog_from_dict(spark, DEMO, LANGUAGES)


def seeds(spark, sf_dir):
    """One seed row per order; the class is drawn."""
    names = F.array(*[F.lit(c) for c in CLASSES])
    label = F.element_at(names, (draw(SEED, F.col("o_orderkey"), "label") % 3 + 1).cast("int"))
    orders = spread(spark, sf_dir, "orders", "o_orderkey")
    return orders.select(F.col("o_orderkey").alias("record_id"), label.alias("label"))


def _typed(kind):
    def run(spark, sf_dir):
        return ex.expand_rows(seeds(spark, sf_dir), _catalog(spark), SEED, conv_type=kind, rewrite=False).drop("noised")

    return run


def lang_pick(spark, sf_dir):
    return ex.with_language(seeds(spark, sf_dir), _catalog(spark), SEED).select("record_id", "label", "lang")


def conv_type(spark, sf_dir):
    return ex.with_conv_type(seeds(spark, sf_dir), SEED)


def expand_dataset(spark, sf_dir):
    return ex.expand_rows(seeds(spark, sf_dir), _catalog(spark), SEED)


def _augmented(spark, sf_dir, **steps):
    rows = spread_scan(records(spark, sf_dir).drop("source"))
    return ex.augment(rows, _catalog(spark), SEED, **steps)


def _catalogs(spark, sf_dir):
    """One catalogue per document, built from its words; some parts are left out by doc_id."""
    docs = spread(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 4
    lines = F.split("text", "\n")
    registers = F.map_from_arrays(F.array(F.lit("imperative"), F.lit("fragment")), F.array(lines, F.array("source")))
    templates = F.create_map(
        F.when(kind == 1, "ko").otherwise(F.col("lang")), registers
    )
    cls = F.struct(
        templates.alias("templates"),
        F.create_map(F.lit("word"), F.split("text", " "), F.lit("lang"), F.array("lang")).alias("slot_lists"),
        F.when(kind != 2, F.create_map(F.lit("en"), lines)).alias("situation_corpus"),
        F.create_map(F.lit("en"), F.array("source")).alias("conversational_wrappers"),
        F.create_map(F.lit("vs_other"), F.lit("")).alias("cross_class_discriminators"),
        F.create_map(F.lit("short_pct"), F.lit(0.5)).alias("length_profile"),
    )
    body = F.struct(
        F.create_map(F.when(kind == 3, "second").otherwise("main"), cls).alias("classes"),
        F.create_map(F.col("lang"), F.array("source", "lang")).alias("compound_bridges"),
        F.when(kind != 0, F.create_map(F.lit("x"), F.lit("y"))).alias("noise_patterns"),
    )
    return docs.select(F.col("doc_id").cast("string").alias("catalog_id"), F.to_json(body).alias("body"))


QUERIES = {
    "lang_pick": lang_pick,
    "conv_type": conv_type,
    **{f"expand_{kind.lower()}": _typed(kind) for kind, _ in TYPES},
    "expand_dataset": expand_dataset,
    "augment_transform": lambda s, d: _augmented(s, d, noise=False),
    "augment_noise": lambda s, d: _augmented(s, d, transform=False),
    "catalog_summary": lambda s, d: cl.catalog_summary(_catalogs(s, d)),
    "catalog_validation": lambda s, d: cl.validate_catalog(_catalogs(s, d), ["main"]),
}

# --- SQL -------------------------------------------------------------------------------------

_classes = DEMO["classes"]
_templates, _sits, _wraps, _slots, _langs = [], [], [], [], []
for _label, _cls in _classes.items():
    for _lang, _registers in _cls["templates"].items():
        _pos = 0
        for _register, _pool in _registers.items():
            for _rpos, _text in enumerate(_pool if isinstance(_pool, list) else []):
                _templates.append((_label, _lang, _register, _pos, _rpos, _text))
                _pos += 1
    for _lang, _pool in _cls["situation_corpus"].items():
        _sits += [(_label, _lang, i, t) for i, t in enumerate(_pool)]
    for _lang, _pool in _cls["conversational_wrappers"].items():
        _wraps += [(_label, _lang, i, t) for i, t in enumerate(_pool)]
    _slots += [(_label, s, i, v) for s, vs in _cls["slot_lists"].items() for i, v in enumerate(vs)]
    _have = [x for x in [*LANGUAGES, "mixed"] if any(t[0] == _label and t[1] == x for t in _templates)]
    _weights = [{"en": 0.4, "ko": 0.4, "mixed": 0.2}.get(x, 0.1) for x in _have]
    _edges = reduce(lambda acc, w: [*acc, acc[-1] + w], _weights, [0.0])
    _langs += [(_label, x, lo, hi, _edges[-1]) for x, lo, hi in zip(_have, _edges, _edges[1:])]
_bridges = [(x, i, t) for x, ts in DEMO["compound_bridges"].items() for i, t in enumerate(ts)]
_fillers = [(x, i, t) for x, ts in DEMO["noise_patterns"]["filler_words"].items() for i, t in enumerate(ts)]
_others = [(c, i, o) for c in CLASSES for i, o in enumerate(x for x in CLASSES if x != c)]

TABLES_SQL = f"""templates(label, lang, register, pos, rpos, text) AS {values(_templates)},
situations(label, lang, pos, text) AS {values(_sits)},
wrappers(label, lang, pos, text) AS {values(_wraps)},
slots(label, slot, pos, value) AS {values(_slots)},
bridges(lang, pos, text) AS {values(_bridges)},
fillers(lang, pos, text) AS {values(_fillers)},
others(label, pos, other) AS {values(_others)},
lang_edges(label, lang, lo, hi, total) AS {values(_langs)},
n_any AS (SELECT label, lang, count(*) AS n FROM templates GROUP BY ALL),
n_reg AS (SELECT label, lang, register, count(*) AS n FROM templates GROUP BY ALL),
n_sit AS (SELECT label, lang, count(*) AS n FROM situations GROUP BY ALL),
n_wrap AS (SELECT label, lang, count(*) AS n FROM wrappers GROUP BY ALL),
n_bridge AS (SELECT lang, count(*) AS n FROM bridges GROUP BY ALL),
n_filler AS (SELECT lang, count(*) AS n FROM fillers GROUP BY ALL),
seeds AS (SELECT o_orderkey AS record_id,
  (['simple', 'reasoning', 'agentic'])[{sql_draw('o_orderkey', 'label')} % 3 + 1] AS label FROM orders),
langed AS (SELECT s.record_id, s.label, e.lang FROM seeds s JOIN lang_edges e ON e.label = s.label
  AND {sql_unit('record_id', 'lang')} * CAST(e.total AS DOUBLE) >= CAST(e.lo AS DOUBLE)
  AND {sql_unit('record_id', 'lang')} * CAST(e.total AS DOUBLE) < CAST(e.hi AS DOUBLE))"""
_ID = "record_id"
_KIND = sql_weighted(TYPES, sql_unit(_ID, "conv_type"))


def _slot_fill_sql(column: str, label: str, out: str, name: str, source: str) -> str:
    """CTE that fills the slots of ``column``, by joining the pieces with the slot lists."""
    plain = SLOT.replace("(", "(?:")
    idx = f"'{name}#' || CAST(i - 1 AS VARCHAR)"
    return f"""{out}_p AS (SELECT record_id, {label} AS label, {column} AS t,
    regexp_split_to_array({column}, '{plain}') AS parts, regexp_extract_all({column}, '{SLOT}', 1) AS names FROM {source}),
{out}_e AS (SELECT record_id, label, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i,
    unnest(list_concat(names, [NULL])) AS slot FROM {out}_p),
{out}_n AS (SELECT label, slot, count(*) AS n FROM slots GROUP BY ALL),
{out}_v AS (SELECT e.record_id, e.i, e.part || CASE WHEN e.slot IS NULL THEN ''
      ELSE coalesce(s.value, '{{' || e.slot || '}}') END AS piece
    FROM {out}_e e LEFT JOIN {out}_n n ON n.label = e.label AND n.slot = e.slot
    LEFT JOIN slots s ON s.label = e.label AND s.slot = e.slot AND s.pos = {sql_draw('e.record_id', idx)} % n.n),
{out} AS (SELECT record_id, string_agg(piece, '' ORDER BY i) AS {out} FROM {out}_v GROUP BY record_id)"""


def _d(name: str, key: str = "t.record_id") -> str:
    return sql_draw(key, name)


def base_sql(kind: str) -> str:
    """CTEs down to ``base``: text and register before transforms and noise."""
    return f"""{TABLES_SQL},
typed AS (SELECT *, {kind} AS conv_type FROM langed),
chosen AS (SELECT t.*, coalesce(tr.text, ta.text) AS template, coalesce(tr.register, ta.register) AS reg,
    si.text AS situation, wr.text AS wrapper, br.text AS bridge, ot.other
  FROM typed t
  LEFT JOIN n_reg nr ON nr.label = t.label AND nr.lang = t.lang
    AND nr.register = CASE t.conv_type WHEN 'D' THEN 'fragment' WHEN 'F' THEN 'implicit' END
  LEFT JOIN templates tr ON tr.label = t.label AND tr.lang = t.lang AND tr.register = nr.register
    AND tr.rpos = {_d('template')} % nr.n
  LEFT JOIN n_any na ON na.label = t.label AND na.lang = t.lang
  LEFT JOIN templates ta ON ta.label = t.label AND ta.lang = t.lang AND ta.pos = {_d('template')} % na.n
  LEFT JOIN n_sit ns ON ns.label = t.label AND ns.lang = t.lang
    AND (t.conv_type IN ('B', 'D') OR (t.conv_type = 'F' AND {sql_unit('t.record_id', 'situation_use')} < CAST(0.5 AS DOUBLE)))
  LEFT JOIN situations si ON si.label = ns.label AND si.lang = ns.lang AND si.pos = {_d('situation')} % ns.n
  LEFT JOIN n_wrap nw ON nw.label = t.label AND nw.lang = t.lang AND t.conv_type = 'C'
  LEFT JOIN wrappers wr ON wr.label = nw.label AND wr.lang = nw.lang AND wr.pos = {_d('wrapper')} % nw.n
  LEFT JOIN n_bridge nb ON nb.lang = t.lang AND t.conv_type = 'E'
  LEFT JOIN bridges br ON br.lang = nb.lang AND br.pos = {_d('bridge')} % nb.n
  LEFT JOIN others ot ON ot.label = t.label AND t.conv_type = 'E' AND ot.pos = {_d('second')} % 2),
paired AS (SELECT c.*, coalesce(t2.text, c.other, c.label) AS second, coalesce(c.template, '') AS first_raw
  FROM chosen c LEFT JOIN n_any n2 ON n2.label = c.other AND n2.lang = c.lang
  LEFT JOIN templates t2 ON t2.label = c.other AND t2.lang = c.lang AND t2.pos = {_d('second_template', 'c.record_id')} % n2.n),
{_slot_fill_sql('first_raw', 'label', 'plain', 'slot', 'paired')},
{_slot_fill_sql('second', 'coalesce(other, label)', 'other_text', 'second_slot', 'paired')},
joined AS (SELECT p.*, a.plain, CASE WHEN p.template IS NULL THEN p.label ELSE a.plain END AS intent_a, b.other_text
  FROM paired p JOIN plain a ON a.record_id = p.record_id JOIN other_text b ON b.record_id = p.record_id),
base AS (SELECT record_id, label, lang, conv_type,
  CASE
    WHEN conv_type = 'B' AND situation IS NOT NULL
      THEN situation || {sql_pick(['. ', ', so ', ' — '], _ID, 'connector')} || plain
    WHEN conv_type = 'C' AND contains(wrapper, '[INTENT]') THEN replace(wrapper, '[INTENT]', plain)
    WHEN conv_type = 'C' AND wrapper IS NOT NULL THEN wrapper || ', ' || plain
    WHEN conv_type = 'D' AND situation IS NOT NULL
      THEN array_to_string(({sql_words('situation')})[1:15], ' ') || ' — ' || plain
    WHEN conv_type = 'E' AND contains(bridge, '[INTENT_A]') AND contains(bridge, '[INTENT_B]')
      THEN replace(replace(bridge, '[INTENT_A]', intent_a), '[INTENT_B]', other_text)
    WHEN conv_type = 'E' AND bridge IS NOT NULL THEN intent_a || ' ' || bridge || ' ' || other_text
    WHEN conv_type = 'F' AND situation IS NOT NULL
      THEN array_to_string(({sql_words('situation')})[1:8], ' ') || ' — ' || plain
    ELSE plain END AS text,
  CASE conv_type WHEN 'D' THEN CASE WHEN plain = '' THEN 'unknown' ELSE 'fragment' END
    WHEN 'F' THEN 'implicit'
    WHEN 'E' THEN CASE WHEN bridge IS NOT NULL THEN 'compound' ELSE coalesce(reg, 'unknown') END
    ELSE coalesce(reg, 'unknown') END AS register
  FROM joined)"""


def _transform_sql(source: str, out: str, when: str = "true") -> str:
    bare = "regexp_replace(b.text, '[?.,! ]+\\z', '')"
    return f"""{out}_f AS (SELECT b.*, fl.text AS filler, coalesce(n.n, 0) AS n_fillers,
    {sql_draw('b.record_id', 'transform')} % (4 + CASE WHEN coalesce(n.n, 0) > 0 THEN 1 ELSE 0 END) AS way
  FROM {source} b LEFT JOIN n_filler n ON n.lang = b.lang
  LEFT JOIN fillers fl ON fl.lang = n.lang AND fl.pos = {sql_draw('b.record_id', 'prefix_filler')} % n.n),
{out} AS (SELECT b.* REPLACE (CASE WHEN NOT ({when}) OR {sql_unit('b.record_id', 'transform_use')} >= CAST(0.3 AS DOUBLE) THEN b.text
  ELSE CASE way
    WHEN 0 THEN {sql_pick(fv.QUESTION_PREFIXES, 'b.record_id', 'question')} || {bare} || '?'
    WHEN 1 THEN CASE WHEN {sql_unit('b.record_id', 'passive')} < CAST(0.5 AS DOUBLE)
      THEN {quote(fv.PASSIVE_BEFORE)} || b.text ELSE b.text || {quote(fv.PASSIVE_AFTER)} END
    WHEN 2 THEN b.text || ' ' || {sql_pick(fv.SUFFIXES, 'b.record_id', 'suffix')}
    WHEN 3 THEN {sql_pick(fv.FORMAL_PREFIXES, 'b.record_id', 'formal')} || b.text
    ELSE b.filler || ' ' || b.text END END AS text)
  FROM {out}_f b)"""


def _noise_sql(source: str, out: str) -> str:
    idx = "CAST(i - 1 AS VARCHAR)"
    abbr = " ".join(
        f"WHEN lower(w) = {quote(k)} AND {sql_unit('record_id', chr(39) + 'abbr#' + chr(39) + ' || ' + idx)} < CAST(0.05 AS DOUBLE)"
        f" THEN {sql_pick(v, 'record_id', chr(39) + 'abbr_pick#' + chr(39) + ' || ' + idx)}"
        for k, v in DEMO["noise_patterns"]["abbreviations"].items()
    )
    return f"""{out}_f AS (SELECT b.* EXCLUDE (text), b.text AS before, {sql_words('b.text')} AS ws, nf.text AS noise_filler,
    {sql_draw('b.record_id', 'noise')} % (2 + CASE WHEN coalesce(nn.n, 0) > 0 THEN 1 ELSE 0 END) AS noise_way,
    {sql_unit('b.record_id', 'noise_use')} < CAST(0.2 AS DOUBLE) AS noised
  FROM {source} b LEFT JOIN n_filler nn ON nn.lang = b.lang
  LEFT JOIN fillers nf ON nf.lang = nn.lang AND nf.pos = {sql_draw('b.record_id', 'noise_filler')} % nn.n),
{out}_c AS (SELECT *, list_filter(list_transform(ws, lambda w, i: CASE WHEN length(w) >= 4 THEN i END),
    lambda i: i IS NOT NULL) AS cand FROM {out}_f),
{out}_t AS (SELECT *, CASE WHEN len(cand) > 0 THEN cand[{sql_draw('record_id', 'typo_word')} % len(cand) + 1] END AS target FROM {out}_c),
{out}_w AS (SELECT *, ws[target] AS word, {sql_draw('record_id', 'typo_pos')} % (length(ws[target]) - 1) AS spot,
    CAST({sql_draw('record_id', 'insert')} % (len(ws) + 1) AS INTEGER) AS slot_at FROM {out}_t),
{out} AS (SELECT *, CASE WHEN NOT noised THEN before
    WHEN noise_way = 0 THEN CASE WHEN target IS NULL THEN before ELSE array_to_string(list_concat(list_concat(ws[1:target - 1],
      [substr(word, 1, spot) || substr(word, spot + 2, 1) || substr(word, spot + 1, 1) || substr(word, spot + 3)]), ws[target + 1:]), ' ') END
    WHEN noise_way = 1 THEN array_to_string(list_transform(ws, lambda w, i: CASE {abbr} ELSE w END), ' ')
    ELSE array_to_string(list_concat(list_concat(ws[1:slot_at], [noise_filler]), ws[slot_at + 1:]), ' ') END AS text
  FROM {out}_w)"""


def _typed_sql(kind: str) -> str:
    return f"WITH {base_sql(quote(kind))} SELECT record_id, label, lang, conv_type, text, register FROM base"


_MAIN = "CASE doc_id % 4 WHEN 3 THEN 'second' ELSE 'main' END"
_LANG = "CASE doc_id % 4 WHEN 1 THEN 'ko' ELSE lang END"

ORACLES = {
    "lang_pick": f"WITH {TABLES_SQL} SELECT record_id, label, lang FROM langed",
    "conv_type": f"WITH {TABLES_SQL} SELECT record_id, label, {_KIND} AS conv_type FROM seeds",
    **{f"expand_{kind.lower()}": _typed_sql(kind) for kind, _ in TYPES},
    "expand_dataset": f"""WITH {base_sql(_KIND)}, {_transform_sql('base', 'trans', "b.conv_type IN ('A', 'F')")},
        {_noise_sql('trans', 'noisy')}
        SELECT record_id, label, lang, conv_type, text, register, noised FROM noisy""",
    "augment_transform": f"""WITH {RECORDS_SQL}, {TABLES_SQL}, {_transform_sql('records', 'trans')}
        SELECT record_id, text, label, lang FROM trans""",
    "augment_noise": f"""WITH {RECORDS_SQL}, {TABLES_SQL}, {_noise_sql('records', 'noisy')}
        SELECT record_id, text, label, lang, noised FROM noisy""",
    "catalog_summary": f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS catalog_id, {_MAIN} AS label, {_LANG} AS tl, lang, text FROM documents),
        standard(l) AS (VALUES ('en'), ('ko'), ('mixed'))
        SELECT catalog_id, 'templates' AS kind, label, l AS lang,
          CASE WHEN l = tl THEN len(string_split(text, chr(10))) + 1 ELSE 0 END AS n
        FROM (SELECT d.*, l FROM d, standard UNION SELECT *, tl FROM d)
        UNION ALL SELECT catalog_id, 'slot_entries', label, '', len(string_split(text, ' ')) + 1 FROM d
        UNION ALL SELECT catalog_id, 'bridges', '', l, CASE WHEN l = lang THEN 2 ELSE 0 END
        FROM (SELECT d.*, l FROM d, standard UNION SELECT *, lang FROM d)""",
    "catalog_validation": f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS catalog_id, doc_id % 4 AS kind, {_LANG} AS tl FROM documents),
        langs(l) AS (VALUES ('en'), ('ko'), ('mixed')),
        regs(r) AS (VALUES ('imperative'), ('casual'), ('frustrated'), ('uncertain'), ('indirect'), ('implicit'), ('fragment'))
        SELECT catalog_id, 'missing top-level key: noise_patterns' AS error FROM d WHERE kind = 0
        UNION ALL SELECT catalog_id, 'missing class: main' FROM d WHERE kind = 3
        UNION ALL SELECT catalog_id, 'main: missing key ''situation_corpus''' FROM d WHERE kind = 2
        UNION ALL SELECT catalog_id, 'main.templates: missing language ''' || l || '''' FROM d, langs WHERE kind <> 3 AND l <> tl
        UNION ALL SELECT catalog_id, 'main.templates.' || l || ': missing register ''' || r || '''' FROM d, langs, regs
          WHERE kind <> 3 AND l = tl AND r NOT IN ('imperative', 'fragment')""",
}

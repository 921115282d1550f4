"""Personal data: candidate spans, boosted trees, calibrated thresholds.

1. Generators with high recall propose spans, which may overlap: the four base kinds, and ``number``, ``contact`` and ``handle``.
2. Evidence beside a candidate speaks for or against it, whatever the base checks say: the words before a number or handle, what a
   number is part of, the domain of an obfuscated address. Most candidates have none.
3. Every candidate gets features that the evidence of its kind does not use: shape for numbers, form and hint words for addresses,
   code or prose around handles.
4. Gradient boosted trees learn from all candidates with evidence, and from ``examples``: fixed texts of every generator, labelled as
   they were made, so that model and thresholds exist on any input.
5. On the other half of these rows a threshold is set for each generator: the lowest probability from which at least
   ``PRECISION`` of the candidates are positive, or ``STRICT`` where no probability is.
6. Candidates of the base kinds that pass their check always stay. Of the others, those that overlap none of them are added
   when the evidence is for them, or when there is none and they are at or above their threshold.

Everything runs in SQL functions and DataFrame operations of the JVM. Nulls: a null text is empty, a null doc_id is kept and its
row scanned. Equal rows are scanned once and returned as often as given. Other columns are ignored.
"""

from __future__ import annotations

import json
import random

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .spans import Rule, kind_names, located, row_key

PRECISION = 0.98
STRICT = 0.95  # threshold of a generator that reaches PRECISION nowhere
TREES, DEPTH, BINS = 16, 4, 200
LEAST_DIGITS = 7  # of an added span that is mostly digits
CONTEXT = 24  # characters on either side that features look at


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _octets(c: Column) -> Column:
    return F.forall(F.split(c, "\\."), lambda part: part.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))


#: The base rules. Groups are possessive, so long texts need no deep stack; an e-mail address starts where a
#: run of its characters starts, or where the match before ended.
BASE = [
    Rule(
        "email",
        "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
        base=True,
    ),
    Rule("ip", "[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+", valid=lambda: _octets(F.col("match")), base=True),
    Rule(
        "card",
        "[0-9](?:[\\x20-]?[0-9])++",
        valid=lambda: F.length(_digits(F.col("match"))).between(12, 19) & _luhn(_digits(F.col("match"))),
        base=True,
    ),
    Rule("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", valid=lambda: F.length(_digits(F.col("match"))).between(9, 15), base=True),
]
#: Generators beyond the base rules.
MORE = [
    Rule("number", "(?:\\([0-9]{2,5}\\)[\\x20.-]?)?+[0-9](?:[\\x20./()-]{0,2}[0-9]){6,}+"),
    Rule(
        "contact",
        "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\\x20?(?:\\(at\\)|\\[at\\])\\x20?[A-Za-z0-9-]++"
        "(?:(?:\\.|\\x20?(?:\\(dot\\)|\\[dot\\])\\x20?)[A-Za-z0-9-]++)*+",
    ),
    Rule("handle", "(?<![A-Za-z0-9._%+-])@[A-Za-z0-9_]{3,}+"),
]
RULES = BASE + MORE
_LINK = "(?:[^A-Za-z0-9]{1,3}(?:number|numbers|no|nr|is|was|me|us|at|on|under))*[^A-Za-z0-9]{0,3}$"
_CALL = "phone|telephone|tel|call|mobile|cell|fax|whatsapp|sms|dial"
#: Words right before a candidate that speak for it, by kind; ``number`` takes those of all personal numbers.
HINTS = {
    "ip": "ip|ip address|host",
    "card": "card|visa|mastercard|amex|account|iban",
    "phone": _CALL,
    "number": _CALL + "|ssn|social security|iban|account|passport|card|visa|mastercard|amex|tax id|national id",
    "handle": "follow|twitter|instagram|telegram|mastodon|github|dm|message|contact|user|username|handle|by|via|cc|ping|thanks|ask",
}
MAIL_HINTS = "(?i)\\b(?:e-?mail|mail|contact|write|reach|address|send)\\b[^@]{0,12}$"
#: Words right before a number that speak against it, and words that are no names of people.
COUNTED = (
    "(?i)(?:\\b(?:order|invoice|isbn|issn|doi|version|build|page|line|total|sum|price|date|serial|part|item|sku|lot|model|year|ticket|case"
    "|figure|table|about|over|exactly|population|row|rows)(?:[^A-Za-z0-9]{1,3}(?:number|no|nr|id|is|was|of))*[^A-Za-z0-9]{0,3}|[$€£#=])$"
)
DATE = (
    "^(?:(?:19|20)[0-9]{2}[-./](?:0?[1-9]|1[0-2])[-./](?:0?[1-9]|[12][0-9]|3[01])"
    "|(?:0?[1-9]|[12][0-9]|3[01])[-./](?:0?[1-9]|[12][0-9]|3[01])[-./](?:19|20)[0-9]{2})(?![0-9])"
)
CODE = (
    "(?i)^@(?:override|deprecated|test|param|params|return|returns|throws|see|since|author|version|media|import|include|charset|keyframes|supports|"
    "property|staticmethod|classmethod|dataclass|pytest|interface|implementation|end|class|selector|todo|brief|file|autowired|bean|null|nullable)$"
)
PLACES = "(?i)(?:\\)|\\])\\x20?(?:the|a|an|this|that|these|those|noon|night|midnight|home|work|least|most|all|once|first|last|times|[0-9]+)$"
DOMAIN = "(?i)(?:\\.|\\x20?(?:\\(dot\\)|\\[dot\\])\\x20?)[a-z]{2,24}$"
FEATURES = [
    "f_length", "f_digits", "f_letters", "f_dots", "f_dashes", "f_blanks", "f_slashes", "f_groups", "f_first", "f_last", "f_plus",
    "f_luhn", "f_octets", "f_digit_share", "f_base", "f_contact", "f_handle", "f_mail_hint", "f_line_start", "f_code_after",
]


def examples() -> list[tuple[str, str, int]]:
    """(text, kind, label): fixed texts with one candidate of ``kind`` each. Its label is 1 for personal data."""
    rng = random.Random(7)
    names = "jane john.doe mary_k ali smith92 lena wei olga-p t.brown k.sato".split()
    hosts = "example acme posteo my-site uni mailhost corp nordnet".split()
    prose = "then we went|lorem ipsum dolor|as said before|der alte mann|il est venu|and so on,|she wrote|the note:".split("|")
    out = []

    def digits(form: str) -> str:
        return "".join(rng.choice("23456789") if c == "9" else c for c in form)

    def put(kind: str, label: int, forms: list[str], times: int = 8) -> None:
        for form in forms:
            for _ in range(times):
                text = digits(form).replace("NAME", rng.choice(names)).replace("WORD", rng.choice(names[3:6]) + rng.choice(["", "_x", "42"]))
                out.append((text.replace("HOST", rng.choice(hosts)).replace("PROSE", rng.choice(prose)), kind, label))

    put("number", 1, [
        "PROSE 999-999-9999 PROSE", "PROSE (999) 999-9999 PROSE", "PROSE 999.999.9999 PROSE", "PROSE 999 999 9999 PROSE", "PROSE 999-99-9999 PROSE",
        "PROSE 1-999-999-9999 PROSE", "PROSE 099 9999 9999 PROSE", "PROSE 0999/9999999 PROSE", "PROSE 099-9999999 PROSE", "PROSE 09 99 99 99 99 PROSE",
    ])
    put("number", 0, [
        "PROSE 9999999 PROSE", "PROSE 99999999 PROSE", "PROSE 9999999999 PROSE", "PROSE 999999999999 PROSE", "PROSE 9999999999999999 PROSE",
        "PROSE 9 999 999 PROSE", "PROSE 99 999 999 PROSE", "PROSE 999.999.999 PROSE", "PROSE 9.99999999 PROSE", "PROSE 9999.9999 PROSE",
        "PROSE 2019-05-19 PROSE", "PROSE 19/05/2019 PROSE", "PROSE 19.05.2019 PROSE", "PROSE 2019 2020 2021 PROSE", "PROSE 9 9 9 9 9 9 9 9 PROSE",
        "PROSE 99 99 99 99 99 99 99 99 PROSE", "PROSE 979-9-99-999999-9 PROSE", "PROSE 9999 9999 9999 9999 9999 PROSE", "PROSE 999 999 999 PROSE",
    ])
    put("contact", 1, ["PROSE NAME (at) HOST PROSE", "PROSE NAME[at]HOST PROSE", "PROSE NAME(at)HOST PROSE", "PROSE NAME [at] HOST PROSE", "PROSE NAME (at) HOST.org PROSE", "mail NAME [at] HOST [dot] com"])
    put("contact", 0, ["PROSE 99 (at) 9 PROSE", "PROSE 999 [at] 99 PROSE", "PROSE 9.99(at)99 PROSE"], 12)
    put("handle", 1, ["PROSE @WORD PROSE", "PROSE (@WORD) PROSE", "PROSE @WORD, PROSE", "PROSE @WORD"], 12)
    put("handle", 0, ["\n@WORD(x)", "\n  @WORD\n", "\n * @WORD x", "@WORD {", "x;\n@WORD;"], 12)
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """(key, rule, start, end, match, ok, before, after) of every generator's matches; ``ok``: the kind's check holds."""
    texts = docs.select(row_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    open_rules = {n: r._replace(valid=None) for n, r in enumerate(RULES)}
    found = located(texts, open_rules, around=CONTEXT)
    ok = F.lit(False)
    for n, rule in enumerate(RULES):
        if rule.base:
            ok = F.when(F.col("rule") == n, F.lit(True) if rule.valid is None else rule.valid()).otherwise(ok)
    return found.withColumn("ok", F.coalesce(ok, F.lit(False)))


def features(found: DataFrame) -> DataFrame:
    match, digits = F.col("match"), _digits(F.col("match"))
    groups = F.split(F.regexp_replace(match, "^[^A-Za-z0-9]+", ""), "[^A-Za-z0-9]+")

    def count(pattern: str) -> Column:
        return (F.length(match) - F.length(F.regexp_replace(match, pattern, ""))).cast("double")

    def of(kind: str, value: Column) -> Column:
        """``value`` for the candidates of one kind, 0 for others."""
        return (value & (F.col("rule") == _number(kind))).cast("double")

    return found.withColumns({
        "f_length": F.length(match).cast("double"),
        "f_digits": F.length(digits).cast("double"),
        "f_letters": count("[A-Za-z]"),
        "f_dots": count("[.]"),
        "f_dashes": count("-"),
        "f_blanks": count("\\x20"),
        "f_slashes": count("[/()]"),
        "f_groups": F.size(groups).cast("double"),
        "f_first": F.length(F.element_at(groups, 1)).cast("double"),
        "f_last": F.length(F.element_at(groups, -1)).cast("double"),
        "f_plus": F.startswith(match, F.lit("+")).cast("double"),
        "f_luhn": (F.length(digits).between(2, 30) & F.coalesce(_luhn(digits), F.lit(False))).cast("double"),
        "f_octets": (F.size(F.split(match, "\\.")) == 4).cast("double") * _octets(match).cast("double"),
        "f_digit_share": F.length(digits) / F.length(match),
        "f_base": (F.col("rule") < len(BASE)).cast("double"),
        "f_contact": of("contact", F.lit(True)),
        "f_handle": of("handle", F.lit(True)),
        "f_mail_hint": of("contact", F.col("before").rlike(MAIL_HINTS)),
        "f_line_start": of("handle", F.col("before").rlike("(?:^|\n)[\\x20\t*/#]*$")),
        "f_code_after": of("handle", F.col("after").rlike("^(?:[({;=.]|[\\x20\t]*[{\n])")),
    })


def _number(kind: str) -> int:
    return next(n for n, rule in enumerate(RULES) if rule.kind == kind)


def plausible() -> Column:
    """A candidate that is mostly digits has enough of them."""
    digits, letters = F.length(_digits(F.col("match"))), F.length(F.regexp_replace("match", "[^A-Za-z]", ""))
    return (digits >= LEAST_DIGITS) | (digits < letters)


def evidence() -> Column:
    """1: what stands beside a candidate speaks for personal data, 0: against it, NULL: neither."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    part = before.rlike("[A-Za-z0-9_]$|[0-9][.,:/-]$") | after.rlike("^(?:[A-Za-z0-9_]|[.,:/-][0-9])")
    against = part | before.rlike(COUNTED) | match.rlike(DATE)
    out = F.lit(None).cast("int")
    for kind, words in HINTS.items():
        no = match.rlike(CODE) if kind == "handle" else against
        told = F.when(no, 0).when(before.rlike(f"(?i)\\b(?:{words}){_LINK}"), 1)
        out = F.when(F.col("rule") == _number(kind), told).otherwise(out)
    told = F.when(match.rlike(PLACES), 0).when(match.rlike(DOMAIN), 1)
    return F.when(F.col("rule") == _number("contact"), told).otherwise(out)


def labelled(found: DataFrame) -> DataFrame:
    """``touched``: the candidate passes its check, or overlaps a candidate of its text that does; and its ``evidence``."""
    order = Window.partitionBy("key").orderBy("start")
    reach = F.max(F.when(F.col("ok"), F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, -1))
    same = F.max(F.when(F.col("ok"), F.col("end"))).over(order.rangeBetween(0, 0))
    following = F.min(F.when(F.col("ok"), F.col("start"))).over(order.rangeBetween(0, Window.unboundedFollowing))
    touched = (reach > F.col("start")) | same.isNotNull() | (following < F.col("end"))
    return found.withColumns({"touched": F.col("ok") | F.coalesce(touched, F.lit(False)), "evidence": evidence()})


def _example_rows(spark: SparkSession) -> DataFrame:
    """Candidates of the examples; those of another kind than the example's are negative."""
    given = json.dumps([{"doc_id": n, "text": t, "kind": k, "label": y} for n, (t, k, y) in enumerate(examples())])
    texts = spark.range(1).select(F.inline(F.from_json(F.lit(given), "array<struct<doc_id:bigint,text:string,kind:string,label:int>>")))
    texts = texts.withColumn("key", row_key())
    found = candidates(texts).join(F.broadcast(texts.select("key", "kind", "label").distinct()), "key")
    own = F.when(kind_names(RULES) == F.col("kind"), F.col("label")).otherwise(0)
    return found.filter(~F.col("ok") & plausible()).withColumn("positive", own.cast("double")).drop("kind", "label")


def train(marked: DataFrame) -> tuple[GBTClassificationModel, DataFrame]:
    """The trees and the threshold of every generator (rule, threshold), from all candidates with evidence and the examples."""
    rows = marked.filter(F.col("evidence").isNotNull() & ~F.col("touched") & plausible())
    rows = rows.withColumn("positive", F.col("evidence").cast("double"))
    rows = rows.drop("touched", "evidence").unionByName(_example_rows(marked.sparkSession))
    half = F.pmod(F.xxhash64(F.lit("half"), "key"), F.lit(2))
    rows = materialize(_assembled(features(rows)).withColumn("half", half), "learned")
    trees = GBTClassifier(
        labelCol="positive", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False
    ).fit(rows.filter("half = 0"))
    bins = _probability(trees, rows.filter("half = 1")).withColumn("bin", F.floor(F.col("probable") * BINS))
    counts = bins.groupBy("rule", "bin").agg(F.count("*").alias("n"), F.sum("positive").alias("good"))
    down = Window.partitionBy("rule").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("good").over(down) / F.sum("n").over(down)
    kept = counts.withColumn("share", share).filter(F.col("share") >= PRECISION)
    reached = kept.groupBy("rule").agg((F.min("bin") / BINS).alias("threshold"))
    every = marked.sparkSession.range(len(RULES)).select(F.col("id").cast("int").alias("rule"))
    thresholds = every.join(reached, "rule", "left").select("rule", F.coalesce("threshold", F.lit(STRICT)).alias("threshold"))
    return trees, materialize(thresholds, "thresholds")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def _probability(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("probable", F.element_at(vector_to_array("probability"), 2))


def pii_spans(docs: DataFrame) -> DataFrame:
    """(key, rule, kind, start, end, base) of all redactions; ``key`` is ``row_key()`` of the row."""
    found = materialize(labelled(candidates(docs)), "candidates")
    columns = ["key", "rule", "start", "end"]
    kept = found.filter("ok").select(*columns, F.lit(True).alias("base"))
    trees, thresholds = train(found)
    others = found.filter(~F.col("touched") & plausible())
    told = others.filter("evidence = 1")
    scored = _probability(trees, _assembled(features(others.filter("evidence IS NULL"))))
    scored = scored.join(F.broadcast(thresholds), "rule").filter(F.col("probable") >= F.col("threshold"))  # one row per generator
    added = told.select(*columns).unionByName(scored.select(*columns)).withColumn("base", F.lit(False))
    return kept.unionByName(added).select("key", "rule", kind_names(RULES).alias("kind"), "start", "end", "base")

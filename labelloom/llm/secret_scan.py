"""Secret scan: a trigram inverted index finds the texts in which a rule's pattern is tried at all.

1. ``trigram_query``  derives from a pattern which trigrams a matching text must hold: alternatives (OR) of trigram sets
   (AND), in lower case. A pattern without mandatory trigrams has none.
2. ``postings``  the index: (trigram, key) for the trigrams of all rules.
3. ``candidates``  intersects the postings of every alternative.
4. The patterns are tried on the candidates; rules without mandatory trigrams are tried on all texts.

Everything runs in SQL functions. Nulls: a null text is empty, a null doc_id is kept and its row scanned. Equal rows are
scanned once and returned as often as given. Matches of different rules may overlap; each is reported. Other columns are ignored.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .spans import Rule, kind_names, located, row_key, span_text

MAX_STRINGS = 64  # literal strings of a pattern that are followed at once


def _length(least: int) -> Callable[[], Column]:
    return lambda: F.length("value") >= least


_BREAK = "(?:[\\x20\t]*+(?:\r\n?+|\n|\\\\r\\\\n|\\\\n))"  # an end of line, also as an escape
KEY_BEGIN = "-----BEGIN "  # every private key begins with it
_BEGIN = KEY_BEGIN + "[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_TO_END = "(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
#: Without an END line: header fields, then lines of base64, or a long run of base64 on the same line.
_LINES = (
    f"(?:{_BREAK}[A-Za-z-]++:\\x20[^\r\n\\\\]*+)*+(?:{_BREAK}++[\\x20\t>|]*+[A-Za-z0-9+/]++=*+(?=[\\x20\t]*+(?:[\r\n\\\\\"',]|$)))*+"
    "(?:\\x20++[A-Za-z0-9+/]{40,}+=*+(?![^\\s\\\\\"',]))*+"
)
#: A private key from its BEGIN line to its END line.
PRIVATE_KEY = f"{_BEGIN}(?:{_TO_END}|{_LINES})"
#: The base rules, then further well-known formats. A run of 32 or more hex digits is the run as a whole.
RULES = [
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, _length(8), True),
    Rule("access", "AKIA[A-Z0-9]+", 0, _length(16), True),
    Rule("hex", "[0-9a-f]{32,}", 0, None, True),
    Rule("private_key", PRIVATE_KEY),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+"),
    Rule("url_login", "[a-z][a-z0-9+.-]{0,20}://[^\\s/:@]*+:[^\\s/@]{3,}+@"),
    Rule("github", "github_pat_[A-Za-z0-9_]{22,}"),
]


# --- trigram queries -------------------------------------------------------------------------


def _strings(items) -> list[set[str] | None]:
    """Pieces of a parsed pattern in order: sets of the literal strings that may stand there, None where that is open."""
    out: list[set[str] | None] = []
    for op, value in items:
        if op is sre.LITERAL:
            out.append({chr(value).lower()})
        elif op is sre.IN and len(value) <= 8 and all(o is sre.LITERAL for o, _ in value):
            out.append({chr(v).lower() for _, v in value})
        elif op is sre.SUBPATTERN:
            out += _strings(value[3])
        elif op is sre.BRANCH:
            options = [_whole(_strings(x)) for x in value[1]]
            out.append(None if any(o is None for o in options) else set().union(*options))
        elif op is sre.MAX_REPEAT or op is sre.MIN_REPEAT or op is sre.POSSESSIVE_REPEAT:
            least, most, inner = value
            once = _strings(inner)
            if (least, most) == (0, 1) and (whole := _whole(once)) is not None:
                out.append(whole | {""})
            else:
                out += once * min(least, 3)
                out.append(None)
        elif op is not sre.AT:
            out.append(None)
    return out


def _whole(pieces: list[set[str] | None]) -> set[str] | None:
    joined = {""}
    for piece in pieces:
        if piece is None:
            return None
        joined = {a + b for a in joined for b in piece}
        if len(joined) > MAX_STRINGS:
            return None
    return joined


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of trigrams of which a matching text, in lower case, holds one entirely; None: it may hold any."""
    pieces = _strings(sre_parser.parse(pattern))
    best, at = None, 0
    while at < len(pieces):
        joined, end = {""}, at
        while end < len(pieces) and (more := _whole([joined, pieces[end]])) is not None:
            joined, end = more, end + 1
        if all(len(s) >= 3 for s in joined):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in joined}
            query = sorted((s for s in sets if not any(other < s for other in sets)), key=sorted)
            if best is None or min(map(len, query)) > min(map(len, best)):
                best = query
        at = max(end, at + 1)
    return best


# --- the operator ------------------------------------------------------------------------------


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram number, key) over ``texts`` (key, text) for some trigrams."""
    lower = texts.select("key", F.lower("text").alias("low"))  # a column of its own: made once for all trigrams
    flags = lower.select("key", *[F.contains("low", F.lit(t)).alias(f"t{n}") for n, t in enumerate(trigrams)])
    held = F.array_compact(F.array(*[F.when(F.col(f"t{n}"), F.lit(n)) for n in range(len(trigrams))]))
    return flags.select("key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(key, rules): texts whose postings satisfy an alternative of a rule's query, and the numbers of these rules."""
    number = {t: n for n, t in enumerate(trigrams)}
    held = index.groupBy("key").agg(*[
        F.bit_or(
            F.when(
                F.floor(F.col("trigram") / 60) == w,
                F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % 60).cast("int")),
            )
        ).alias(f"w{w}")
        for w in range((len(trigrams) + 59) // 60)
    ])

    def satisfied(alternative: frozenset[str]) -> Column:
        masks: dict[int, int] = {}
        for t in alternative:
            masks[number[t] // 60] = masks.get(number[t] // 60, 0) | 1 << (number[t] % 60)
        out = F.lit(True)
        for w, mask in masks.items():
            out = out & (F.coalesce(F.col(f"w{w}"), F.lit(0)).bitwiseAND(F.lit(mask)) == mask)
        return out

    rules = []
    for rule, query in queries.items():
        some = F.lit(False)
        for alternative in query:
            some = some | satisfied(alternative)
        rules.append(F.when(some, F.lit(rule)))
    return held.select("key", F.array_compact(F.array(*rules)).alias("rules")).filter(F.size("rules") > 0)


def secret_spans(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(key, rule, kind, start, end, base) of every secret; ``key`` is ``row_key()`` of the row."""
    texts = docs.select(row_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    scanned = {n: r for n, r in enumerate(rules) if n not in queries}
    trigrams = sorted({t for q in queries.values() for alternative in q for t in alternative})
    found = []
    if queries:
        index = materialize(postings(texts, trigrams), "index")
        hits = materialize(candidates(index, trigrams, queries), "candidates")
        # small candidate sets are broadcast by Spark, which knows the size of a written table
        rows = texts.join(hits, "key")
        found.append(located(rows, {n: rules[n] for n in queries}, {n: F.array_contains("rules", n) for n in queries}))
    if scanned:
        found.append(located(texts, scanned))
    spans = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    base = F.array_contains(F.array(*[F.lit(n) for n, r in enumerate(rules) if r.base] or [F.lit(-1)]), F.col("rule"))
    return spans.select("key", "rule", kind_names(rules).alias("kind"), "start", "end", base.alias("base"))


def per_row(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id and ``spans``: array of start, rule, end, kind, base; empty without secrets)."""
    one = F.struct("start", "rule", "end", "kind", "base")
    grouped = spans.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    kind = "array<struct<start:bigint,rule:int,end:bigint,kind:string,base:boolean>>"
    rows = docs.select("doc_id", row_key().alias("key")).join(grouped, "key", "left")
    return rows.select("doc_id", F.coalesce(F.col("spans").cast(kind), F.array().cast(kind)).alias("spans"))


def redact(docs: DataFrame, spans: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; overlapping spans become one. All columns and rows stay."""
    one = F.struct("start", "end")
    grouped = spans.groupBy("key").agg(F.array_sort(F.collect_set(one)).alias("__spans"))
    rows = docs.withColumn("__key", row_key()).join(grouped.withColumnRenamed("key", "__key"), "__key", "left")
    text = F.col("text")
    # walk over the sorted spans: the text so far and where it ends
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))
    walked = F.aggregate(
        "__spans", start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["out"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mask))).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    cleaned = F.when(F.col("__spans").isNotNull(), walked).otherwise(text)
    return rows.select(*[cleaned.alias("text") if c == "text" else F.col(c) for c in docs.columns])

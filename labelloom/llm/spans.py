"""Places of pattern matches in texts, with SQL functions only.

Spark's functions return what matched but not where. The text between the matches is what ``split`` gives, so the place of
a match is the sum of the lengths before it: one running sum per text and rule, over the rows of its matches.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``pattern``: Java regular expression. ``group``: the part that ``valid`` looks at (as column ``value``)."""

    kind: str
    pattern: str
    group: int = 0
    valid: Callable[[], Column] | None = None
    base: bool = False


def row_key() -> Column:
    """Content key of a row with doc_id and text: equal rows share it (64 bits)."""
    return F.xxhash64(F.lit("row"), "doc_id", "text")


def _matches(text: Column, number: int, rule: Rule, wanted: Column, around: int) -> Column:
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        gaps.alias("gap"),
        *([F.slice(gaps, 2, F.size(gaps)).alias("after")] if around else []),
    )
    found = F.transform(
        F.filter(zipped, lambda x: x["match"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(number).alias("rule"), i.alias("i"), x["match"].alias("match"), x["value"].alias("value"),
            F.length(x["gap"]).alias("gap"),
            *([F.right(x["gap"], F.lit(around)).alias("before"), F.left(x["after"], F.lit(around)).alias("after")] if around else []),
        ),
    )
    kind = f"array<struct<rule:int,i:int,match:string,value:string,gap:int{',before:string,after:string' if around else ''}>>"
    return F.when(wanted & text.rlike(rule.pattern), found).otherwise(F.array().cast(kind))


def located(
    rows: DataFrame, rules: dict[int, Rule], wanted: dict[int, Column] | None = None, around: int = 0
) -> DataFrame:
    """(key, rule, start, end, match, value) of every valid match in ``rows`` (key, text).

    Matches of a rule do not overlap and are taken from the left; invalid ones are dropped. Places are code points.
    ``around``: add so many characters ``before`` and ``after`` each match, up to the next match of the rule.
    """
    text = F.col("text")
    lists = [_matches(text, n, r, F.lit(True) if wanted is None else wanted[n], around) for n, r in rules.items()]
    found = rows.select("key", F.explode(F.concat(*lists)).alias("m")).select("key", "m.*").distinct()  # of equal rows
    order = Window.partitionBy("key", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(order)
    placed = found.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    ok = F.lit(True)
    for n, rule in rules.items():
        if rule.valid is not None:
            ok = F.when(F.col("rule") == n, rule.valid()).otherwise(ok)
    more = ["before", "after"] if around else []
    return placed.filter(ok).select("key", "rule", "start", "end", "match", "value", *more)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then rule number, joined by commas; ``spans``: array of (start, rule, end, kind)."""
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def kind_names(rules: list[Rule]) -> Column:
    return F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)

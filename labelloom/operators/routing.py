"""Request routing: an ordered list of steps, the first match wins.

A step turns the text into STRUCT<label, confidence, text, method>, or NULL for no match. All
native steps of a route form one projection; nothing is shuffled and no Python runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import let, token_count
from .datasets import remap_labels

Matcher = Callable[[Column], Column]


@dataclass(frozen=True)
class Step:
    """``match`` for a native step; ``score`` (DataFrame -> DataFrame) for a classifier step."""

    method: str
    match: Matcher | None = None
    score: Callable[[DataFrame], DataFrame] | None = None
    label_map: DataFrame | None = None
    labels: tuple[str, ...] = ()  # what the step can answer, where that is known
    patterns: tuple[str, ...] = ()  # regular expressions given by the user


def _found(method: str, label, text: Column, confidence=1.0) -> Column:
    label = label if isinstance(label, Column) else F.lit(label)
    confidence = confidence if isinstance(confidence, Column) else F.lit(float(confidence))
    return F.struct(
        label.alias("label"),
        confidence.cast("double").alias("confidence"),
        text.alias("text"),
        F.lit(method).alias("method"),
    )


def _checked(method: str, rules: list) -> None:
    """Mistakes in a step show up when the route is built, not when it runs."""
    if not rules:
        raise ValueError(f"{method} step without rules")


def _first(cases: list[tuple[Column, Column]]) -> Column:
    (cond, value), *rest = cases
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out


def literal_pattern(word: str) -> str:
    """Pattern that matches ``word`` itself, valid in Java and RE2."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", word)


def word_pattern(words: list[str]) -> str:
    """Any of ``words``; an edge that is a letter, digit or ``_`` must be a word edge."""
    word_char = re.compile(r"\w")

    def bounded(word: str) -> str:
        before = rf"(?:^|{fv.NOT_WORD_CHAR})" if word_char.match(word[0]) else ""
        after = rf"(?:{fv.NOT_WORD_CHAR}|\z)" if word_char.match(word[-1]) else ""
        return before + literal_pattern(word) + after

    return "|".join(bounded(w) for w in words)


def substring_pattern(words: list[str]) -> str:
    return "|".join(literal_pattern(w) for w in words)


def prefix(rules: list[tuple[str, str]], strip_prefix: bool = True) -> Step:
    """Rules (prefix, label) in order; the prefix and the white space after it are removed."""
    _checked("prefix", rules)

    def match(text: Column) -> Column:
        def rest(p: str) -> Column:
            if not strip_prefix:
                return text
            return F.regexp_replace(F.substr(text, F.lit(len(p) + 1)), rf"^{fv.SPACE}+", "")

        return _first([(F.startswith(text, F.lit(p)), _found("prefix", label, rest(p))) for p, label in rules])

    return Step("prefix", match)


def code_block(label: str = "code") -> Step:
    """A closed fence, or two consecutive lines indented by four spaces."""

    def match(text: Column) -> Column:
        opened = F.instr(text, fv.FENCE)
        fenced = (opened > 0) & (F.position(F.lit(fv.FENCE), text, opened + len(fv.FENCE)) > 0)
        indented = text.rlike(r"(?:^|\n) {4}[^\n]*\n {4}")
        return _first([(fenced | indented, _found("code_block", label, text))])

    return Step("code_block", match)


def question(label: str = "chat") -> Step:
    words = "|".join(fv.QUESTION_WORDS)

    def match(text: Column) -> Column:
        ends = text.rlike(rf"\?{fv.SPACE}*\z")
        opens = text.rlike(rf"(?i)^(?:{words})(?:{fv.NOT_WORD_CHAR}|\z)")
        return _first([(ends | opens, _found("question", label, text))])

    return Step("question", match)


def regex(rules: list[tuple[str, str]]) -> Step:
    """Rules (pattern, label) in order, searched in the whole text; flags go inside the pattern."""
    _checked("regex", rules)

    def match(text: Column) -> Column:
        return _first([(text.rlike(pattern), _found("regex", label, text)) for pattern, label in rules])

    return Step("regex", match, labels=tuple(label for _, label in rules), patterns=tuple(p for p, _ in rules))


def keyword(
    rules: list[tuple[list[str], str]],
    case_sensitive: bool = False,
    match: str = "any",
    match_mode: str = "word",
) -> Step:
    """Rules (words, label) in order. ``match``: any | all; ``match_mode``: word | substring."""
    _checked("keyword", rules)
    for words, label in rules:
        _checked(f"keyword ({label})", words)
        if "" in words:
            raise ValueError(f"keyword ({label}): empty word")
    if match not in ("any", "all") or match_mode not in ("word", "substring"):
        raise ValueError(f"keyword step: match={match}, match_mode={match_mode}")

    def hit(text: Column, words: list[str]) -> Column:
        if match_mode == "substring" and case_sensitive:
            tests = [F.contains(text, F.lit(w)) for w in words]
        else:
            flags = "" if case_sensitive else "(?iu)"
            groups = [words] if match == "any" else [[w] for w in words]
            pattern = word_pattern if match_mode == "word" else substring_pattern
            tests = [text.rlike(flags + pattern(g)) for g in groups]
        out = tests[0]
        for test in tests[1:]:
            out = (out | test) if match == "any" else (out & test)
        return out

    def matcher(text: Column) -> Column:
        return _first([(hit(text, words), _found("keyword", label, text)) for words, label in rules])

    return Step("keyword", matcher, labels=tuple(label for _, label in rules))


def ascii_share(text: Column) -> Column:
    """Share of ASCII letters among the letters; NULL without letters."""
    letters = F.regexp_replace(text, r"\P{L}+", "")
    ascii_letters = F.regexp_replace(letters, r"[^A-Za-z]+", "")
    return F.try_divide(F.length(ascii_letters).cast("double"), F.length(letters).cast("double"))


def language(
    non_english_label: str,
    english_label: str | None = None,
    min_confidence: float = 0.85,
    lang_col: str | None = None,
    confidence_col: str | None = None,
) -> Step:
    """Non-English texts get a label; English ones a label or fall through.

    With ``lang_col`` the language comes from the table and must reach ``min_confidence``.
    Without it, the share of ASCII letters is the confidence that a text is English.
    """

    def match(text: Column) -> Column:
        if lang_col:
            confidence = F.col(confidence_col) if confidence_col else F.lit(1.0)
            sure = confidence >= F.lit(min_confidence)
            english = sure & (F.col(lang_col) == "en")
            foreign = sure & (F.col(lang_col) != "en")
        else:
            confidence = ascii_share(text)
            english = confidence >= F.lit(min_confidence)
            foreign = confidence < F.lit(min_confidence)
        cases = [(foreign, _found("language", non_english_label, text, confidence))]
        if english_label is not None:
            cases.append((english, _found("language", english_label, text, confidence)))
        return _first(cases)

    return Step("language", match)


def length(rules: list[dict], unit: str = "chars") -> Step:
    """Rules {min, max, label} in order, inclusive; ``unit``: chars | tokens."""
    _checked("length", rules)
    if any("min" not in r and "max" not in r for r in rules):
        raise ValueError("length rule without min or max")
    if unit not in ("chars", "tokens"):
        raise ValueError(f"length unit: {unit}")

    def match(text: Column) -> Column:
        n = F.length(text) if unit == "chars" else token_count(text)

        def within(rule: dict) -> Column:
            cond = F.lit(True)
            if "min" in rule:
                cond = cond & (n >= rule["min"])
            if "max" in rule:
                cond = cond & (n <= rule["max"])
            return cond

        return _first([(within(rule), _found("length", rule["label"], text)) for rule in rules])

    return Step("length", match)


def always(label: str = "default") -> Step:
    return Step("always", lambda text: _found("always", label, text))


def custom(method: str, match: Matcher) -> Step:
    """A method of the user's own: text column -> struct(label, confidence, text) or NULL."""
    def matcher(text: Column) -> Column:
        def named(found: Column) -> Column:
            own = _found(method, found["label"], found["text"], found["confidence"])
            return F.when(found.isNotNull(), own)

        return let(match(text), named)

    return Step(method, matcher)


def classifier(
    score: Callable[[DataFrame], DataFrame], label_map: DataFrame | None = None, method: str = "classifier"
) -> Step:
    """``score`` adds ``label`` and ``confidence`` and keeps every row and other column.

    It sees each row once, whatever the number of classifier steps; rows that an earlier step matched come with
    a NULL text. A NULL label falls through to the next step.
    """
    return Step(method, score=score, label_map=label_map)


# --- routes -------------------------------------------------------------------------------

DECISION = "struct<label:string,confidence:double,text:string,method:string>"


def _decide(steps: list[Step], text: Column) -> Column:
    """Decision of the first matching native step (NULL if none)."""
    tries = [step.match(text) for step in steps]
    return F.coalesce(*tries) if tries else F.lit(None).cast(DECISION)


def _spread(df: DataFrame) -> DataFrame:
    """Decision columns from ``__decision``; the text is replaced only by a match."""
    d = F.col("__decision")
    return df.withColumns(
        {
            "label": d["label"],
            "method": d["method"],
            "confidence": d["confidence"],
            "text": F.coalesce(d["text"], F.col("text")),
        }
    ).drop("__decision")


def route(df: DataFrame, steps: list[Step], strict: bool = False) -> DataFrame:
    """Add ``label, method, confidence, error`` and the (possibly stripped) ``text``.

    Other columns pass through. Rows no step matches get ``error = pipeline_exhausted``, or
    fail the query with ``strict=True``. One pass: the decision so far travels with the row through every
    classifier step, so a random or remote scorer is asked once for a row and its answer is used once.
    """
    if not steps:
        raise ValueError("a route needs at least one step")
    own = [c for c in df.columns if c not in ("label", "method", "confidence", "error")]
    decided, native = df.select(*own), []
    decided = decided.withColumn("__decision", F.lit(None).cast(DECISION))
    for step in [*steps, None]:
        if step is not None and step.score is None:
            native.append(step)
            continue
        if native:
            now = F.coalesce(F.col("__decision"), _decide(native, F.col("text")))
            decided, native = decided.withColumn("__decision", now), []
        if step is not None:
            decided = _scored(decided, step)
    out = _spread(decided)
    error = F.lit("pipeline_exhausted")
    return out.withColumn("error", F.when(F.col("method").isNull(), F.raise_error(error) if strict else error))


def _scored(df: DataFrame, step: Step) -> DataFrame:
    """``df`` with the decisions of one classifier step for the rows that have none."""
    open_rows = F.col("__decision").isNull()
    asked = df.withColumns({"__text": F.col("text"), "text": F.when(open_rows, F.col("text"))})
    scored = step.score(asked)
    if step.label_map is not None:
        scored = remap_labels(scored, step.label_map)
    found = _found(step.method, F.col("label"), F.col("__text"), F.col("confidence"))
    now = F.when(open_rows & F.col("label").isNotNull(), found).otherwise(F.col("__decision"))
    return scored.withColumns({"__decision": now, "text": F.col("__text")}).select(*df.columns)


def validate_route(steps: list[Step], routes: list[str] | None = None) -> list[str]:
    """Faults of a route, in words: empty, patterns that do not compile, steps that are never reached, labels without a chain."""
    from pyspark.errors import PySparkException

    faults = [] if steps else ["a route needs at least one step"]
    for at, step in enumerate(steps):
        if step.method == "always" and at + 1 < len(steps):
            faults.append(f"step {at + 1}: steps after always are never reached")
        for pattern in step.patterns:
            try:
                SparkSession.active().range(1).select(F.lit("").rlike(pattern)).collect()
            except PySparkException:
                faults.append(f"step {at + 1} ({step.method}): pattern does not compile: {pattern}")
        for label in step.labels:
            if routes is not None and label not in routes:
                faults.append(f"step {at + 1} ({step.method}): no chain for label {label}")
    return faults


def explain(df: DataFrame, steps: list[Step], key: str = "request_id") -> DataFrame:
    """One row per request and step: did it match, with which label, was it reached.

    A classifier step is asked for every row, once; its answer tells what it would have said.
    """
    rows = df.select(key, "text")
    for i, step in enumerate(steps):
        if step.score is not None:
            scored = step.score(rows)
            if step.label_map is not None:
                scored = remap_labels(scored, step.label_map)
            rows = scored.select(*rows.columns, F.col("label").alias(f"__label_{i}"))
    labels = [
        s.match(F.col("text"))["label"] if s.score is None else F.col(f"__label_{i}") for i, s in enumerate(steps)
    ]
    tries = F.array(
        *[F.struct(F.lit(s.method).alias("method"), label.alias("label")) for s, label in zip(steps, labels, strict=True)]
    )

    def traced(trace: Column) -> Column:
        first = F.array_position(F.transform(trace, lambda t: t["label"].isNotNull()), True)
        return let(
            first,
            lambda at: F.transform(
                trace,
                lambda t, i: F.struct(
                    i.alias("step"),
                    t["method"].alias("method"),
                    t["label"].isNotNull().alias("matched"),
                    t["label"].alias("label"),
                    ((at == 0) | (i < at)).alias("reached"),
                ),
            ),
        )

    return rows.select(key, F.explode(let(tries, traced)).alias("t")).select(key, "t.*")


def decision_mix(decisions: DataFrame) -> DataFrame:
    """Rows, share and fallback rate per method and label."""
    fallback = F.col("fallback_used") if "fallback_used" in decisions.columns else F.lit(False)
    cells = decisions.groupBy("method", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(fallback, F.lit(False)).cast("bigint")).alias("fallbacks")
    )
    # one row per method and label, so the total needs no second pass over the decisions
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return cells.withColumn("total", total).select(
        "method",
        "label",
        "n",
        (F.col("n") / F.col("total")).alias("share"),
        (F.col("fallbacks") / F.col("n")).alias("fallback_rate"),
    )


__all__ = [
    "Step", "always", "ascii_share", "classifier", "code_block", "custom", "decision_mix", "explain",
    "keyword", "language", "length", "prefix", "question", "regex", "route", "validate_route",
]

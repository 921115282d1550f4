"""Model-assisted data: prompts, completions and rephrasings through a user's function.

User functions run in ``mapInPandas`` and ``mapInArrow`` tasks. They are not deterministic, so write their
output before using it twice (``naturalize`` appends chunk by chunk).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions.text import reply_lines
from ..sources.ledger import Ledger
from ..sources.records import append_records
from ..session import ensure_checkpoint_dir
from .datasets import pending, stratified_sample
from .scale import checked_broadcast, cutoffs, join_on

CALLED = 256  # rows whose replies a task holds at a time


def _fill(template: str, **values: Column) -> Column:
    """Concatenate the pieces of ``template`` with column values for its ``{names}``."""
    pieces = re.split(r"(\{\w+\})", template)
    return F.concat(*[values[p[1:-1]] if re.fullmatch(r"\{\w+\}", p) else F.lit(p) for p in pieces if p])


def generation_prompt(
    label: Column, need: Column, goal: Column, classes: Column, descriptions: Column
) -> Column:
    """Prompt for ``need`` more examples; the layout depends on whether descriptions exist."""
    n = need.cast("string")

    def quoted(name: Column) -> Column:
        return F.concat(F.lit('"'), name, F.lit('"'))

    def described(name: Column) -> Column:
        text = F.element_at(descriptions, name)
        return F.when(text.isNotNull(), F.concat(quoted(name), F.lit(" ("), text, F.lit(")"))).otherwise(quoted(name))

    def joined(names: Column, show) -> Column:
        return F.array_join(F.transform(names, show), ", ")

    others = F.filter(classes, lambda c: c != label)
    head = [_fill(fv.PROMPT_HEAD, n=n, label=label), _fill(fv.PROMPT_TASK, goal=goal)]
    tail = _fill(fv.PROMPT_TAIL, n=n)
    long_form = [
        *head,
        _fill(fv.PROMPT_CLASS, description=F.coalesce(F.element_at(descriptions, label), F.lit(""))),
        _fill(fv.PROMPT_LABELS, labels=joined(classes, described)),
        F.lit(fv.PROMPT_RULES_DESCRIBED),
        _fill(fv.PROMPT_FOCUS, label=label, others=joined(others, described)),
        tail,
    ]
    short_form = [
        *head,
        _fill(fv.PROMPT_LABELS, labels=joined(classes, quoted)),
        _fill(fv.PROMPT_RULES_PLAIN, label=label),
        tail,
    ]
    has_descriptions = F.coalesce(F.size(descriptions) > 0, F.lit(False))
    return F.when(has_descriptions, F.concat_ws("\n", *long_form)).otherwise(F.concat_ws("\n", *short_form))


CATALOG_PROMPT = (
    "Write a template catalogue as one JSON object.\n"
    "Classes:\n{class_definitions}\nLanguages: {languages}\nFollow this schema:\n{schema}"
)


def catalog_prompt(
    tasks: DataFrame, schema: str = "", template: str = CATALOG_PROMPT, keys: tuple[str, ...] = ("task_id",)
) -> DataFrame:
    """Catalogue prompt per task from rows (keys, ``label, idx, description, languages``)."""
    line = F.concat(F.lit("- **"), "label", F.lit("**: "), "description")
    rows = tasks.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("idx", line.alias("line")))).alias("lines"),  # one entry per class
        F.first("languages").alias("languages"),
    )
    prompt = _fill(
        template,
        class_definitions=F.array_join(F.transform("lines", lambda x: x["line"]), "\n"),
        languages=F.array_join("languages", ", "),
        schema=F.lit(schema),
    )
    return rows.select(*keys, prompt.alias("prompt"))


def complete(
    prompts: DataFrame, fn: Callable[[str], str], partitions: int | None = None, col: str = "prompt", ledger: Ledger | None = None
) -> DataFrame:
    """Call ``fn`` once per prompt. Adds ``reply`` and ``error``; a failure never stops the others.

    With a ``ledger`` tasks that are tried again, and later runs, ask only what has no reply yet.
    """
    fn = fn if ledger is None else ledger.through(fn)
    schema = T.StructType(
        prompts.schema.fields + [T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(frames):
        for pdf in frames:
            replies, errors = [], []
            for prompt in pdf[col]:
                try:
                    replies.append(fn(prompt))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - reported per row
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf.assign(reply=replies, error=errors)

    spread = prompts.repartition(partitions) if partitions else prompts
    return spread.mapInPandas(run, schema)


def reply_examples(completions: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per cleaned line of each reply: keys, ``order``, ``line_no``, ``text``."""
    kept = completions.filter(F.col("reply").isNotNull())
    return kept.select(*keys, order, F.posexplode(reply_lines(F.col("reply"))).alias("line_no", "text"))


def ingest_completions(
    completions: DataFrame, need: DataFrame, keys: list[str] | None = None, order: str = "completion_id"
) -> DataFrame:
    """The first ``need`` example lines per class, in completion order (an integer).

    Replies with the same number come in the order of a hash of their text; replies that are equal in both are interchangeable.
    The cut is found from the number of lines per reply; replies beyond it are dropped before their lines become rows, and
    the replies at the cut share what is left.
    """
    keys = keys or ["label"]
    kept = completions.filter(F.col("reply").isNotNull()).withColumn("__hash", F.try_add(F.xxhash64("reply"), F.lit(0).cast("bigint")))  # nullable, like the other keys
    lines = reply_lines(F.col("reply"))
    quotas = need.select(*keys, F.col("need").alias("quota"))
    number = F.try_add(F.col(order).cast("bigint"), F.lit(0).cast("bigint"))
    cuts = cutoffs(kept, keys, [number, F.col("__hash")], quotas=quotas, weight=F.size(lines))
    place = F.struct(number.alias("o0"), F.col("__hash").alias("o1"))
    joined = join_on(kept, checked_broadcast(cuts), keys, "inner").filter(F.col("take_all") | (place <= F.col("cut")))
    last = ~F.col("take_all") & (place == F.col("cut"))
    whole = joined.filter(~last).select(*keys, order, lines.alias("__lines"))
    equal = Window.partitionBy(*keys).orderBy("__hash").rowsBetween(Window.unboundedPreceding, -1)  # the equal replies at a cut
    shared = joined.filter(last).withColumn("__left", F.col("part") - F.coalesce(F.sum(F.size(lines)).over(equal), F.lit(0)))
    taken = F.slice(lines, F.lit(1), F.greatest(F.col("__left"), F.lit(0)).cast("int"))
    every = whole.unionByName(shared.select(*keys, order, taken.alias("__lines")))
    return every.select(*keys, order, F.posexplode("__lines").alias("line_no", "text"))


def rephrase(
    df: DataFrame,
    fn: Callable[[str], str],
    partitions: int | None = None,
    threads: int = 8,
    attempts: int = fv.REPHRASE_ATTEMPTS,
    wait_s: float = fv.REPHRASE_WAIT_S,
    is_rate_limit: Callable[[Exception], bool] | None = None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Replace ``text`` by ``fn(text)``; every input row comes out, with ``original_text``.

    A rate limit (an error named ``RateLimit...`` or with ``status_code`` 429) is retried
    after ``wait_s`` times the attempt; any other error, an empty reply, or running out of
    attempts keeps the original. ``threads`` calls run at a time in each task. With a ``ledger``
    tasks that are tried again, and later runs, ask only what has no reply yet.
    """
    fn = fn if ledger is None else ledger.through(fn)
    fields = [f for f in df.schema.fields if f.name not in ("original_text", "error")]
    schema = T.StructType(
        fields + [T.StructField("original_text", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(batches):
        import time
        from concurrent.futures import ThreadPoolExecutor

        def limited(e: Exception) -> bool:
            if is_rate_limit is not None:
                return is_rate_limit(e)
            named = any(c.__name__.startswith("RateLimit") for c in type(e).__mro__)
            return named or getattr(e, "status_code", None) == 429

        def one(text):
            for attempt in range(attempts):
                try:
                    reply = fn(text)
                    if not reply:
                        return text, "empty reply"
                    return reply.strip(), None
                except Exception as e:  # noqa: BLE001 - the row keeps its text
                    if not limited(e):
                        return text, f"{type(e).__name__}: {e}"
                    time.sleep(wait_s * (attempt + 1))
            return text, "rate limit"

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, CALLED):  # a batch is held once, replies only of some rows
                    part = batch.slice(start, CALLED)
                    given = part.column("text")
                    texts, errors = zip(*pool.map(one, given.to_pylist()), strict=True)
                    own = {"text": pa.array(texts, given.type), "original_text": given, "error": pa.array(errors, pa.string())}
                    yield pa.RecordBatch.from_arrays([own[n] if n in own else part.column(n) for n in schema.names], schema.names)

    kept = df.select(*[f.name for f in fields])
    spread = kept.repartition(partitions) if partitions else kept
    return spread.mapInArrow(run, schema)


def naturalize_rows(
    df: DataFrame, fn: Callable[[str], str], n: int, seed: int = 99, done: DataFrame | None = None, **options
) -> DataFrame:
    """Sample ``n`` rows by class, drop those already rephrased, rephrase the rest."""
    sample = stratified_sample(df, n, seed)
    return rephrase(pending(sample, done) if done is not None else sample, fn, **options)


def naturalize(
    df: DataFrame,
    fn: Callable[[str], str],
    path: str,
    n: int,
    seed: int = 99,
    done: DataFrame | None = None,
    chunks: int = 1,
    **options,
) -> None:
    """``naturalize_rows``, appended to ``path``.

    Each of the ``chunks`` is its own job, so a failure loses at most one of them and a
    rerun with ``done`` (the rows at ``path``) does only what is missing.
    """
    sample = stratified_sample(df, n, seed)
    todo = pending(sample, done) if done is not None else sample
    if chunks > 1:  # sampled once; the chunks read the written rows
        ensure_checkpoint_dir(df.sparkSession)
        todo = todo.checkpoint()
    part = F.pmod(F.xxhash64("record_id"), F.lit(chunks))
    for i in range(chunks):
        append_records(rephrase(todo.filter(part == i) if chunks > 1 else todo, fn, **options), path)

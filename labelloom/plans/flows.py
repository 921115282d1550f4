"""End-to-end flows made of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.classify import NaiveBayes, train_naive_bayes
from ..operators.datasets import class_deficit, merge, stratified_split
from ..operators.evaluate import evaluate, evaluation_report, per_class_metrics, release_gates
from ..operators.scale import checked_broadcast
from ..operators.supervise import complete, generation_prompt, ingest_completions
from ..session import ensure_checkpoint_dir
from ..sources.ledger import Ledger
from ..sources.records import append_records, read_records


def train_and_gate(
    datasets: list[DataFrame],
    evaluation: DataFrame,
    latency: DataFrame,
    classes: list[str],
    ratio: float = 0.2,
    seed: int = 42,
    group_col: str | None = None,
    recall_class: str | None = None,
    **train_options,
) -> tuple[NaiveBayes, DataFrame]:
    """Merge, split, train on the train part, score ``evaluation`` and apply the release gates."""
    split = stratified_split(merge(*datasets), ratio, seed, group_col)
    model = train_naive_bayes(split.filter(F.col("split") == "train"), classes, **train_options)
    metrics = per_class_metrics(model.predict(evaluation), classes)
    return model, release_gates(metrics, latency, recall_class=recall_class)


EXAMPLE = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])


def generated(spark: SparkSession, path: str) -> DataFrame:
    """The examples at ``path``, without lines that cannot be read; none where nothing has been written yet."""
    try:
        return read_records(spark, path, EXAMPLE, mode="tolerant")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EXAMPLE)


def generate(
    classes: DataFrame, path: str, n: int, goal: str, fn: Callable[[str], str], rounds: int = 1, ledger: Ledger | None = None, **options
) -> DataFrame:
    """Fill every class up to ``n`` examples: count what is there, prompt for what is missing, take that many lines of the reply, append.

    ``classes`` has ``label`` and may have ``description``. The flow goes on where an earlier run stopped: it starts from the records at ``path``. A
    class whose call fails gets nothing in this round and is prompted again in the next of ``rounds``; with a ``ledger`` no
    prompt is asked again after a reply. The records are appended once a round, from replies that are written first (checkpoint).

    Returns label, have, need, written and error of every class and round that had something to ask.
    """
    spark = classes.sparkSession
    ensure_checkpoint_dir(spark)
    described = classes if "description" in classes.columns else classes.withColumn("description", F.lit(None).cast("string"))
    every = described.agg(
        F.sort_array(F.collect_list("label")).alias("classes"),  # the list of classes is part of every prompt
        F.map_from_entries(F.collect_list(F.when(F.col("description").isNotNull(), F.struct("label", "description")))).alias("descriptions"),
    )
    summary = None
    for turn in range(rounds):
        missing = class_deficit(generated(spark, path), classes.select("label"), n).checkpoint()
        if missing.isEmpty():
            break
        asked = missing.crossJoin(F.broadcast(every))  # one row of ``every``
        prompt = generation_prompt(F.col("label"), F.col("need"), F.lit(goal), F.col("classes"), F.col("descriptions"))
        prompts = asked.select("label", "need", F.lit(turn).alias("round"), prompt.alias("prompt"))
        replies = complete(prompts, fn, ledger=ledger, **options).checkpoint()
        taken = ingest_completions(replies.withColumn("completion_id", F.lit(0).cast("bigint")), missing)
        taken = taken.filter(F.col("label").isNotNull()).select("text", "label").checkpoint()
        append_records(taken, path)
        written = taken.groupBy("label").agg(F.count(F.lit(1)).alias("written"))
        row = missing.join(checked_broadcast(written), "label", "left").join(replies.select("label", "error"), "label", "left")
        row = row.select(
            F.lit(turn).alias("round"), "label", "have", "need", F.coalesce("written", F.lit(0).cast("bigint")).alias("written"), "error"
        )
        summary = row if summary is None else summary.unionByName(row)
    if summary is None:
        return spark.createDataFrame([], "round int, label string, have long, need long, written long, error string")
    return summary


def split_and_evaluate(
    records: DataFrame,
    classes: list[str],
    signals: DataFrame | None = None,
    latency: DataFrame | None = None,
    ratio: float = 0.2,
    seed: int = 42,
    group_col: str | None = None,
    **train_options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split, train on one part and evaluate the other on all axes: the scored rows, a verdict per axis, and the figures behind them.

    The scored rows are written once (checkpoint); verdicts and figures read them.
    """
    ensure_checkpoint_dir(records.sparkSession)
    split = stratified_split(records, ratio, seed, group_col)
    model = train_naive_bayes(split.filter(F.col("split") == "train"), classes, **train_options)
    scored = model.predict(split.filter(F.col("split") == "val")).drop("scores", "split").checkpoint()
    return scored, evaluate(scored, classes, signals, latency), evaluation_report(scored, classes, signals, latency)

"""Mixing sources to target weights with hash-threshold histograms.

Sizes are numbers of words. Sources, in the order of their code points with null last, have the weights 1, 2, 3 and so on again;
together they share the size of the whole corpus. No target is above ``most`` times the size of its source: what is too much goes to
the other sources by weight until none is above.

Method: a document's key is a hash of its id and text. Words are summed by source and first digits of the key (the histogram).
A source takes all its documents ``times`` times; the rest of its target is the budget of one more copy: documents below
a threshold get it. The running sum over the histogram gives the bucket that holds the threshold; only this boundary bucket is cut
finer, until it has few rows. Its documents are then taken in the order of their keys while they fit, and one more, the smallest
left, when that comes nearer to the budget. All other documents are decided by comparing their keys: nothing is sorted. Thresholds
are nested: more budget for a source keeps every document below the smaller budget's boundary bucket.

Nulls and odd rows: a null text has size 0; null sources are one source; null ids and repeated rows are documents
of their own (equal rows are told apart by their place in the written table, which changes no result: they give equal rows).
A source of size 0 has target 0. Other columns are ignored, but for those named in ``keep``; of columns with the name of a result the result stays.
An empty table gives no rows. A document is taken whole, so a source misses its target by the size of its smallest documents at most,
or, with few documents, by as much as one of them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
SEED = 11
DIGITS = 32  # hexadecimal digits of a key
STEP = 3  # digits of one histogram: 4,096 buckets for each source
BUCKET_ROWS = 512  # a boundary bucket is not cut finer than to about so many rows
EDGE_ROWS = 8_192  # a boundary bucket with more rows is cut
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 4_000_000
RESULTS = ("size", "source_size", "target", "times", "taken")


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Written rows (``keep``, __src, __key, size)."""
    source = F.col("source").cast("string")
    return materialize(
        docs.select(
            *[c for c in keep if c not in RESULTS],
            F.when(source.isNull(), "z").otherwise(F.concat(F.lit("a"), source)).alias("__src"),
            F.concat(
                _hex(F.xxhash64(F.lit(SEED), "doc_id", "text")), _hex(F.xxhash64(F.monotonically_increasing_id()))
            ).alias("__key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sized",
    )


def _numbered(keys: DataFrame, column: str) -> DataFrame:
    """``number`` of each row in the order of ``column``, from 0: sorted in ranges, and the ranges counted."""
    ranges = materialize(keys.repartitionByRange(column).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(column))
    joined = ranges.withColumn("__at", inside).join(starts, "__range")
    return joined.withColumn("number", F.col("__start") + F.col("__at") - 1).drop("__range", "__at", "__start")


def _level(sources: DataFrame, most: int) -> float:
    """Size for a weight of 1, such that the targets, each at most ``most`` times its source, sum to all sizes."""
    cap, given = F.lit(most) * F.col("source_size"), F.lit(0.0)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = cap <= given * F.col("weight")
        row = sources.agg(F.count(F.when(above, 1)), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if row[0] == capped or not row[2]:
            return level if row[2] else float("inf")
        capped = row[0]
        level = (total - (row[1] or 0)) / row[2]
        given = F.lit(level)


def targets(histogram: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(__src, n, source_size, target, times, budget) of every source, written."""
    sums = histogram.groupBy("__src").agg(F.sum("n").alias("n"), F.sum("size").alias("source_size"))
    given = F.array(*[F.lit(w) for w in weights])
    sources = _numbered(sums, "__src").withColumn("weight", F.element_at(given, (F.col("number") % len(weights) + 1).cast("int")))
    sources = materialize(sources, "sources")
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    sources = sources.withColumn("target", F.least(cap, F.lit(_level(sources, most)) * F.col("weight")))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("times", times.cast("int"))
    budget = F.col("target") - F.col("times") * F.col("source_size")
    return materialize(sources.select("__src", "n", "source_size", "target", "times", budget.alias("budget")), "targets")


def _with_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with the columns of their source: broadcast when small in rows and bytes, else joined on salted sources."""
    size = rules.agg(F.count("*"), F.sum(F.octet_length("__src") + 100)).first()
    if size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(rules), "__src")
    digits = F.array(*[F.lit(d) for d in "0123456789ABCDEF"])
    salted = rules.withColumn("__salt", F.explode(digits))
    return rows.withColumn("__salt", F.substring("__key", DIGITS, 1)).join(salted, ["__src", "__salt"]).drop("__salt")


def _finer(rules: DataFrame, histogram: DataFrame, least_digits: int) -> DataFrame:
    """(__src, edge, budget, n): the bucket of each source where the running sum passes its budget, and what is left there.

    ``rules`` has the bucket so far; ``histogram`` its next ``STEP`` digits. Few rows are cut by fewer digits.
    """
    wanted = F.floor(F.log(F.col("n") / F.lit(BUCKET_ROWS)) / math.log(16))
    digits = F.greatest(F.lit(least_digits), F.least(F.lit(STEP), wanted)).cast("int")
    rule = rules.select("__src", F.col("budget"), (F.length("edge") + digits).alias("__digits"))
    bucket = F.substring("bucket", F.lit(1), F.col("__digits"))
    sums = histogram.join(rule, "__src").groupBy("__src", "budget", bucket.alias("edge")).agg(
        F.sum("n").alias("n"), F.sum("size").alias("size")
    )
    upto = F.sum("size").over(Window.partitionBy("__src").orderBy("edge"))
    sums = sums.withColumn("__upto", upto).filter((F.col("__upto") > F.col("budget")) & (F.col("__upto") - F.col("size") <= F.col("budget")))
    return sums.select("__src", "edge", (F.col("budget") - F.col("__upto") + F.col("size")).alias("budget"), "n")


def boundaries(rows: DataFrame, sources: DataFrame, histogram: DataFrame) -> DataFrame:
    """(__src, edge, budget, n) of the sources that have a budget left: their boundary bucket and its share of the budget."""
    rules = sources.filter("budget > 0").select("__src", F.lit("").alias("edge"), "budget", "n")
    rules = materialize(_finer(rules, histogram, 0), "edges")
    coarse = (F.col("n") > EDGE_ROWS) & (F.length("edge") < DIGITS)
    while not rules.filter(coarse).isEmpty():
        open_rules = rules.filter(coarse)
        inside = _with_rules(rows.select("__src", "__key", "size"), open_rules.select("__src", "edge"))
        inside = inside.filter(F.col("__key").startswith(F.col("edge")))
        bucket = F.substring("__key", F.lit(1), F.length("edge") + STEP)
        finer = inside.groupBy("__src", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        rules = materialize(rules.filter(~coarse).unionByName(_finer(open_rules, finer, 1)), "edges")
    return rules


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one boundary bucket (``EDGE_ROWS`` at most) that get one more copy."""
    rows = rows[rows["size"] > 0].sort_values("__key")
    left, taken, smallest = float(rows["budget"].iloc[0]) if len(rows) else 0.0, [], None
    for key, size in zip(rows["__key"], rows["size"], strict=True):
        if size <= left:
            taken.append(key)
            left -= size
        elif smallest is None or size < smallest[0]:
            smallest = (size, key)
    if smallest is not None and smallest[0] - left < left:
        taken.append(smallest[1])
    return pd.DataFrame({"__src": [rows["__src"].iloc[0]] * len(taken) if taken else [], "__key": taken}, dtype=str)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, size, source_size, target, times and taken (size x times) of every document of ``docs`` (doc_id, text, source)."""
    rows = sized(docs, keep)
    first = F.substring("__key", 1, STEP)
    histogram = rows.groupBy("__src", first.alias("bucket")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    histogram = materialize(histogram, "histogram")
    sources = targets(histogram, weights, most)
    edges = boundaries(rows, sources, histogram)
    rules = materialize(sources.drop("n", "budget").join(edges.select("__src", "edge", "budget"), "__src", "left"), "rules")

    found = _with_rules(rows, rules)
    inside = F.coalesce(F.col("__key").startswith(F.col("edge")), F.lit(False))
    below = F.coalesce(F.substring("__key", F.lit(1), F.length("edge")) < F.col("edge"), F.lit(False))
    chosen = found.filter(inside).select("__src", "__key", "size", "budget").groupBy("__src").applyInPandas(
        _fill, "__src string, __key string"
    )
    edge = found.filter(inside).join(chosen.withColumn("more", F.lit(1)), ["__src", "__key"], "left")
    rest = found.filter(~inside).withColumn("more", below.cast("int"))
    times = (F.col("times") + F.coalesce("more", F.lit(0))).cast("int")
    every = rest.unionByName(edge).withColumn("times", times)
    kept = [c for c in keep if c not in RESULTS]
    return every.select(*kept, "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: every document as often as it is taken."""
    return mixed.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))

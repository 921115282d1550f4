"""Distributed building blocks that stay whole under skew.

* ``checked_broadcast``  broadcast only after counting; otherwise leave the join to Spark
* ``cutoffs``            exact per-group "first k rows" without sorting a whole group
* ``order_statistics``   exact per-group order statistics from value counts
* ``running_before``     prefix aggregates in two levels (blocks, then rows of a block)
* ``hot_salts``          number of salts for the groups that are too large for one task
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import draw
from ..session import ensure_checkpoint_dir

MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 50_000, 64_000_000
BUCKET_SHIFT = 16  # a draw has 32 bits: 65,536 buckets
DRAW_SPAN = (0, 2**32 - 1)


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows and ``MAX_BROADCAST_BYTES``, else return it without a hint.

    At most ``max_rows + 1`` rows are read; the small table then becomes a local
    relation, so it is computed once however often it is joined.
    """
    small = local_copy(df, max_rows)
    return df if small is None else F.broadcast(small)


def local_copy(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame | None:
    """``df`` as a local relation, or None when it has more than ``max_rows`` rows or ``MAX_BROADCAST_BYTES``."""
    rows = df.limit(max_rows + 1).toArrow()
    large = rows.num_rows > max_rows or rows.nbytes > MAX_BROADCAST_BYTES
    return None if large else df.sparkSession.createDataFrame(rows, df.schema)


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores over all of them.

    Meant for work that is heavy per row; ``df`` must come straight from a scan. A large
    table has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _renamed(df: DataFrame, keys: list[str], prefix: str = "__k_") -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe equi join on ``keys``; the right side's keys are dropped."""
    other = _renamed(right, keys)
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(other["__k_" + k])
        cond = term if cond is None else cond & term
    return left.join(other, cond, how).drop(*["__k_" + k for k in keys])


# --- first k rows per group -------------------------------------------------------

BUCKETS = 65_536
EDGE_ROWS = 1_000_000  # more rows than this in one bucket: look closer
MAX_LEVELS = 4


def dense_bucket(value: Column, low: Column, high: Column, buckets: int = BUCKETS) -> Column:
    """Equal-width bucket of a BIGINT key, for ``low <= value <= high``.

    Computed on halved values, so that the full 64-bit range does not overflow.
    """
    value, low, high = (F.shiftright(c, 1) for c in (value, low, high))
    width = F.floor((high - low) / F.lit(buckets)) + 1
    return F.floor((value - low) / width)


def cutoffs(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    quota: Callable[[Column], Column] | None = None,
    quotas: DataFrame | None = None,
    span: tuple[int, int] | None = None,
    weight: Column | None = None,
    edge_rows: int | None = None,
) -> DataFrame:
    """One row per group: the sort key at which its first k rows end.

    ``order[0]`` is an integer, within ``span`` if that is given. While a group has more
    than ``edge_rows`` candidate rows, counts in 65,536 buckets of ``order[0]`` narrow it
    to the bucket that holds the k-th row; only those rows are put in order. Beyond
    ``MAX_BROADCAST_ROWS`` groups, the groups with more rows are a table of their own that is narrowed on. ``k`` is
    ``quota(n)`` of the group size, or the ``quota`` column of ``quotas`` (missing: 0).
    With ``weight`` (a count per row) k counts weight instead of rows.

    Rows that are equal in all of ``order`` are one candidate with a number, so ties are not put
    in order. A bucket whose first key is one value is narrowed by the next integer keys.

    Output: keys, ``take_all`` BOOLEAN (the group has at most k), ``cut`` STRUCT (NULL when
    nothing is taken), ``part`` BIGINT: how much of the weight at ``cut`` is taken, ``at_cut``
    BIGINT: the weight there.
    """
    one = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    keyed = df.select(
        *keys,
        order[0].cast("bigint").alias("__at"),
        F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("__order"),
        one.alias("__weight"),
    )
    edge_rows = EDGE_ROWS if edge_rows is None else edge_rows
    sums = [F.sum("__weight").alias("__total"), F.count(F.lit(1)).alias("__rows")]
    if span is None:
        sums += [F.min("__at").alias("__low"), F.max("__at").alias("__high")]
    groups = keyed.groupBy(*keys).agg(*sums)
    if span is not None:
        groups = groups.withColumns({"__low": F.lit(span[0]).cast("bigint"), "__high": F.lit(span[1]).cast("bigint")})
    if quotas is not None:
        groups = join_on(groups, quotas.select(*keys, F.col("quota").cast("bigint").alias("__left")), keys)
        groups = groups.withColumn("__left", F.coalesce("__left", F.lit(0).cast("bigint")))
    else:
        groups = groups.withColumn("__left", quota(F.col("__total")).cast("bigint"))
    groups = groups.withColumn("take_all", F.col("__total") <= F.col("__left")).drop("__total")
    small = local_copy(groups)
    groups = groups if small is None else F.broadcast(small)

    def crowded(known: DataFrame) -> bool:
        large = (F.col("__rows") > edge_rows) & (F.col("__low") < F.col("__high"))
        return not known.filter(large & (F.col("__left") > 0)).isEmpty()

    open_groups = groups.filter(~F.col("take_all") & (F.col("__left") > 0)).drop("take_all")
    edges = []
    integers = [f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") for f in keyed.schema["__order"].dataType]
    big = (F.col("__rows") > edge_rows) & (F.col("__left") > 0)
    for position in range(len(order)):
        for _ in range(MAX_LEVELS):
            if small is None:  # many groups: those with few rows are done
                ensure_checkpoint_dir(df.sparkSession)
                open_groups = open_groups.checkpoint()
                edges.append(_inside(keyed, open_groups.filter(~big).drop("__rows"), keys))
                open_groups = open_groups.filter(big)
                small = local_copy(open_groups)
                open_groups = open_groups if small is None else F.broadcast(small)
            if small is not None and not crowded(small):
                break
            edge = _edge_bucket(keyed, open_groups.drop("__rows"), keys)
            small = local_copy(edge)
            open_groups = edge if small is None else F.broadcast(small)
        tied = (F.col("__rows") > edge_rows) & (F.col("__low") == F.col("__high")) & (F.col("__left") > 0)
        further = position + 1 < len(order) and integers[position + 1]
        if not further or (small is not None and small.filter(tied).isEmpty()):
            edges.append(_inside(keyed, open_groups.drop("__rows"), keys))
            break
        # groups whose k-th row lies among equal first keys go on with the next key
        edges.append(_inside(keyed, open_groups.filter(~tied).drop("__rows"), keys))
        closer = open_groups.filter(tied).select(*keys, "__low", "__high", "__left")
        keyed = _inside(keyed, closer, keys).withColumn("__at", F.col(f"__order.o{position + 1}").cast("bigint"))
        keyed = keyed.select(*keys, "__at", "__order", "__weight", F.col("__left").alias("__quota"))
        open_groups = keyed.groupBy(*keys).agg(
            F.first("__quota").alias("__left"), F.count(F.lit(1)).alias("__rows"),
            F.min("__at").alias("__low"), F.max("__at").alias("__high"),
        )
        keyed = keyed.drop("__quota")
        small = local_copy(open_groups)
        open_groups = open_groups if small is None else F.broadcast(small)

    at_edge = edges[0]
    for other in edges[1:]:
        at_edge = at_edge.unionByName(other)
    distinct = at_edge.groupBy(*keys, "__order").agg(
        F.sum("__weight").alias("__weight"), F.first("__left").alias("__left")  # the same in every row of a group
    )
    running = (
        Window.partitionBy(*keys).orderBy("__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = distinct.withColumn("__upto", F.sum("__weight").over(running))
    before = F.col("__upto") - F.col("__weight")
    cut = ranked.filter((F.col("__upto") >= F.col("__left")) & (before < F.col("__left"))).select(
        *keys, F.col("__order").alias("cut"), (F.col("__left") - before).alias("part"), F.col("__weight").alias("at_cut")
    )
    return join_on(groups.select(*keys, "take_all"), cut, keys)


def _inside(keyed: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in their group's range ``__low..__high``, with the group's ``__left``."""
    found = join_on(keyed, groups, keys, "inner").filter(F.col("__at").between(F.col("__low"), F.col("__high")))
    return found.select(*keys, "__at", "__order", "__weight", "__left")


def _edge_bucket(keyed: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Narrow each group's range ``__low..__high`` to the bucket where ``__left`` is reached."""
    inside = join_on(keyed, groups, keys, "inner").filter(F.col("__at").between(F.col("__low"), F.col("__high")))
    hist = inside.groupBy(*keys, dense_bucket(F.col("__at"), F.col("__low"), F.col("__high")).alias("__bucket")).agg(
        F.sum("__weight").alias("__n"),
        F.count(F.lit(1)).alias("__rows"),
        F.min("__at").alias("__low"),
        F.max("__at").alias("__high"),
        F.first("__left").alias("__left"),  # the same in every row of a group
    )
    running = (
        Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = hist.withColumn("__upto", F.sum("__n").over(running))
    before = F.col("__upto") - F.col("__n")
    return upto.filter((F.col("__upto") >= F.col("__left")) & (before < F.col("__left"))).select(
        *keys, "__low", "__high", (F.col("__left") - before).alias("__left"), "__rows"
    )


def within_cutoff(
    df: DataFrame, cuts: DataFrame, keys: list[str], order: list[Column], name: str
) -> DataFrame:
    """Add BOOLEAN ``name``: the row is among the first k of its group.

    ``order`` ends with ``row_hash``, so rows at the cut that tie are equal in every column: which of them are
    chosen makes no difference, only how many. They are counted, not ordered. Rows not at such a
    cut are decided in place, without a shuffle.
    """
    cuts = checked_broadcast(cuts)
    joined = join_on(df, cuts, keys)
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    shared = F.coalesce((key == F.col("cut")) & (F.col("part") < F.col("at_cut")), F.lit(False))
    chosen = F.coalesce(F.col("take_all"), F.lit(False)) | F.coalesce(key <= F.col("cut"), F.lit(False))
    extra = ["take_all", "cut", "part", "at_cut"]
    clear = joined.filter(~shared).withColumn(name, chosen).drop(*extra)
    if cuts.filter("part < at_cut").isEmpty():
        return clear
    counted = joined.filter(shared).groupBy(*df.columns).agg(
        F.first("part").alias("__part"), F.count(F.lit(1)).alias("__copies")
    )
    numbered = counted.withColumn("__number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
    tied = numbered.withColumn(name, F.col("__number") <= F.col("__part")).drop("__part", "__copies", "__number")
    return clear.unionByName(tied)


def row_hash(df: DataFrame) -> Column:
    """BIGINT of all columns of a row: the last key of an order, so that only equal rows tie."""
    return F.try_add(F.xxhash64(*df.columns), F.lit(0).cast("bigint"))  # nullable, like the other keys


def draw_bucket(number: Column) -> Column:
    return F.shiftright(number, BUCKET_SHIFT)


# --- order statistics ---------------------------------------------------------------


def _value_bucket(value: Column) -> Column:
    """Monotone logarithmic bucket: 4,096 per factor e, for values of either sign."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(4096.0)).cast("bigint")


def order_statistics(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    edge_rows: int | None = None,
) -> DataFrame:
    """Exact values at 0-based ``ranks`` (functions of the group size) and ``n``, per group.

    Counts per logarithmic bucket locate each rank; if one of those buckets has more than
    ``edge_rows`` rows, it is cut into equal-width slices. Only the rows of the last buckets
    are shuffled by value and put in order.
    """
    edge_rows = EDGE_ROWS if edge_rows is None else edge_rows
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    rows = rows.withColumn("__b1", _value_bucket(F.col("__v")))
    sizes = [F.count(F.lit(1)).alias("__size"), F.min("__v").alias("__min"), F.max("__v").alias("__max")]

    def holding_ranks(buckets: DataFrame) -> DataFrame:
        wanted = F.lit(False)
        for rank in ranks.values():
            target = rank(F.col("__n"))
            wanted = wanted | ((target >= F.col("__start")) & (target < F.col("__start") + F.col("__size")))
        return buckets.filter(wanted)

    def started(buckets: DataFrame, path: list[str], order: str) -> Column:
        before = Window.partitionBy(*(path or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__size").over(before), F.lit(0))

    path = [*keys, "__b1"]
    coarse = rows.groupBy(*path).agg(*sizes)
    total = F.sum("__size").over(Window.partitionBy(*(keys or [F.lit(0)])))
    coarse = coarse.withColumns({"__start": started(coarse, keys, "__b1"), "__n": total})
    coarse = holding_ranks(coarse)
    small = local_copy(coarse)
    coarse = coarse if small is None else F.broadcast(small)
    rows = join_on(rows, coarse, path, "inner")

    crowded = (F.col("__size") > edge_rows) & (F.col("__min") < F.col("__max"))
    if small is None or not small.filter(crowded).isEmpty():
        share = F.try_divide(F.col("__v") - F.col("__min"), F.col("__max") - F.col("__min"))
        rows = rows.withColumn("__b2", F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(65535.0)))
        fine = rows.groupBy(*path, "__b2").agg(
            F.count(F.lit(1)).alias("__size"), F.first("__start").alias("__from"), F.first("__n").alias("__n")
        )
        fine = fine.withColumn("__start", F.col("__from") + started(fine, path, "__b2"))
        path = [*path, "__b2"]
        fine = holding_ranks(fine).select(*path, "__start", "__n")
        rows = join_on(rows.drop("__start", "__n"), checked_broadcast(fine), path, "inner")

    # one row per distinct value of the remaining buckets
    counts = rows.groupBy(*path, "__v").agg(
        F.count(F.lit(1)).alias("__c"), F.first("__start").alias("__start"), F.first("__n").alias("__n")
    )
    inside = Window.partitionBy(*path).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("__upto", F.col("__start") + F.sum("__c").over(inside))
    out = []
    for name, rank in ranks.items():
        target = rank(F.col("__n"))
        hit = (target >= F.col("__upto") - F.col("__c")) & (target < F.col("__upto"))
        out.append(F.max(F.when(hit, F.col("__v"))).alias(name))
    return counts.groupBy(*keys).agg(F.max("__n").alias("n"), *out)


# --- prefix aggregates -----------------------------------------------------------------


def running_before(
    df: DataFrame,
    keys: list[str],
    order: str,
    block: Column,
    specs: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Aggregates over the rows that precede each row of its group.

    ``specs`` maps an output name to (``min`` | ``max`` | ``sum``, expression). A group is cut
    into blocks; totals of earlier blocks are carried in, so no task sees a whole group.
    Keys must not be NULL: the plain equi join and the window then share one partitioning.
    """
    blocked = df.withColumn("__block", block)
    fold = {"min": (F.min, F.least), "max": (F.max, F.greatest), "sum": (F.sum, None)}
    totals = blocked.groupBy(*keys, "__block").agg(
        *[fold[kind][0](expr).alias(name) for name, (kind, expr) in specs.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "__block",
        *[fold[kind][0](F.col(name)).over(earlier).alias("__carry_" + name) for name, (kind, _) in specs.items()],
    )
    joined = blocked.join(carried, [*keys, "__block"], "left")
    inside = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, (kind, expr) in specs.items():
        local, carry = fold[kind][0](expr).over(inside), F.col("__carry_" + name)
        if kind == "sum":
            out[name] = F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        else:
            out[name] = fold[kind][1](local, carry)  # NULL arguments are ignored
    return joined.withColumns(out).drop("__block", *["__carry_" + name for name in specs])


# --- hot groups ----------------------------------------------------------------------------


def hot_salts(df: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Groups with more than ``rows_per_task`` rows and the number of salts each needs.

    The result has fewer than rows / ``rows_per_task`` rows.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    return sizes.filter(F.col("__size") > rows_per_task).select(
        *keys, F.ceil(F.col("__size") / F.lit(rows_per_task)).cast("int").alias("__salts")
    )


def seeded_order(seed, key: str) -> tuple[Column, list[Column]]:
    """Bucket and sort key of a seeded shuffle; ``key`` must be unique."""
    number = draw(seed, F.col(key), "shuffle")
    return draw_bucket(number), [number, F.col(key)]

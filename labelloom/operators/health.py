"""Backend health and fallback chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .scale import checked_broadcast, hot_salts, join_on, local_copy

ROWS_PER_TASK = 1_000_000
CUT_ROUNDS = 4
SALTED = 4  # times ``rows_per_task`` in one cell, after it was cut by time


def _trusted(up: Column, unknown: str) -> Column:
    if unknown not in ("up", "down"):
        raise ValueError(f"unknown: {unknown}")
    return F.coalesce(up, F.lit(unknown == "up"))


def backend_status(health: DataFrame, now: Column, ttl_s: int = 60, unknown: str = "up") -> DataFrame:
    """Latest check per backend: ``checked_at``, ``fresh`` (within the TTL), ``up`` and ``status``."""
    health = health.withColumn("checked_at", F.col("checked_at").cast("timestamp"))
    past = health.filter(F.col("checked_at") <= now)
    latest = past.groupBy("backend").agg(F.max(F.struct("checked_at", "up")).alias("last"))
    fresh = F.col("last.checked_at") >= now - F.expr(f"interval {int(ttl_s)} seconds")
    up = _trusted(F.when(fresh, F.col("last.up")), unknown)
    return latest.select(
        "backend", F.col("last.checked_at").alias("checked_at"), fresh.alias("fresh"), up.alias("up"),
        F.when(up, "up").otherwise("down").alias("status"),
    )


def resolve_routes(routes: DataFrame, status: DataFrame, unknown: str = "up") -> DataFrame:
    """First healthy backend per label: ``label, backend, fallback_used, n_healthy``."""
    chain = routes.select("label", F.posexplode("backends").alias("pos", "backend"))
    known = chain.join(status.select("backend", "up"), "backend", "left")
    healthy = F.when(_trusted(F.col("up"), unknown), F.struct("pos", "backend"))
    best = known.groupBy("label").agg(F.min(healthy).alias("best"))
    return best.select("label", F.col("best.backend").alias("backend"), (F.col("best.pos") > 0).alias("fallback_used"))


def with_error(df: DataFrame, known: Column) -> DataFrame:
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(~known, "unknown_route")
        .when(F.col("backend").isNull(), "no_backends_available")
    )
    return df.withColumn("error", error).withColumn(
        "fallback_used", F.coalesce("fallback_used", F.lit(False))
    )


def resolve_backends(
    decisions: DataFrame,
    routes: DataFrame,
    status: DataFrame,
    default_route: str | None = None,
    unknown: str = "up",
) -> DataFrame:
    """Add ``backend, fallback_used`` and the fallback errors to routed rows.

    A label without a route takes ``default_route``, else ``error = unknown_route``; a chain
    with no healthy backend keeps its label and gets ``error = no_backends_available``.
    """
    resolved = checked_broadcast(resolve_routes(routes, status, unknown).withColumnRenamed("label", "__route"))
    joined = decisions
    if default_route is not None:
        names = checked_broadcast(routes.select(F.col("label").alias("__known")))
        joined = joined.join(names, F.col("label") == F.col("__known"), "left")
        wanted = F.when(F.col("label").isNotNull(), F.coalesce("__known", F.lit(default_route)))
        joined = joined.withColumn("__want", wanted).drop("__known")
    else:
        joined = joined.withColumn("__want", F.col("label"))
    joined = joined.join(resolved, F.col("__want") == F.col("__route"), "left")
    return with_error(joined, F.col("__route").isNotNull()).drop("__want", "__route")


def recent_checks(health: DataFrame, ttl_s: int) -> DataFrame:
    """(backend, __ts, up, __block): one check per instant, in the TTL-long block of its time; the last one of a block is there again
    in the next block."""
    checks = (
        health.groupBy("backend", F.col("checked_at").cast("timestamp").alias("__ts"))
        .agg(F.bool_or("up").alias("up"))
        .withColumn("__block", F.floor(F.unix_micros("__ts") / (int(ttl_s) * 1_000_000)))
    )
    last = checks.groupBy("backend", "__block").agg(F.max(F.struct("__ts", "up")).alias("last"))
    carried = last.select(
        "backend", F.col("last.__ts").alias("__ts"), F.col("last.up").alias("up"), (F.col("__block") + 1).alias("__block")
    )
    return checks.unionByName(carried)


def cut_by_time(df: DataFrame, keys: list[str], ttl_s: int, rounds: list[DataFrame]) -> DataFrame:
    """Add ``__lo`` and ``__span``: start and width, in microseconds, of the cell of ``__at``. Cells are TTL-long blocks, cut as ``rounds`` say."""
    width = int(ttl_s) * 1_000_000
    out = df.withColumns({"__lo": F.floor(F.col("__at") / width) * width, "__span": F.lit(width).cast("long")})
    for cuts in rounds:
        step = F.coalesce("__step", "__span")
        out = join_on(out, cuts, [*keys, "__lo"]).withColumn("__span", step).drop("__step")
        out = out.withColumn("__lo", F.col("__lo") + F.floor((F.col("__at") - F.col("__lo")) / F.col("__span")) * F.col("__span"))
    return out


def crowded_cells(asked: DataFrame, keys: list[str], ttl_s: int, rows_per_task: int) -> list[DataFrame]:
    """(keys, __lo, __step) by round: cells with too many requests and the width of the parts that they are cut into."""
    ensure_checkpoint_dir(asked.sparkSession)
    rounds: list[DataFrame] = []
    for n in range(CUT_ROUNDS):
        sizes = cut_by_time(asked.select(*keys, "__at"), keys, ttl_s, rounds).groupBy(*keys, "__lo", "__span").agg(F.count("*").alias("__size"))
        crowded = sizes.filter((F.col("__size") > rows_per_task * (SALTED if n else 1)) & (F.col("__span") > 1) & F.col("__lo").isNotNull())
        step = F.ceil(F.col("__span") / F.ceil(F.col("__size") / F.lit(rows_per_task))).cast("long")
        crowded = crowded.select(*keys, "__lo", step.alias("__step")).checkpoint()  # read for requests and checks
        small = local_copy(crowded)
        if small is not None and small.isEmpty():
            break
        rounds.append(crowded if small is None else F.broadcast(small))
    return rounds


def in_cells(
    asked: DataFrame, checks: DataFrame, keys: list[str], series: list[str], marks, ttl_s: int, rows_per_task: int
) -> tuple[DataFrame, DataFrame]:
    """Requests and checks with the cell (``keys``, ``__lo``, ``__salt``) in which they meet.

    ``checks`` has ``series`` (of which the keys are a part), ``__block`` and ``__check``. A cell with too many requests is cut by time, so that a check
    stays in one part; a part that has requests takes over the last check of each series from the parts before it. Only a part that
    cannot be cut down, as its requests share an instant, is salted, and its checks are copied. ``marks`` gives cells of requests their series.
    """
    width = int(ttl_s) * 1_000_000
    rounds = crowded_cells(asked, keys, ttl_s, rows_per_task)
    asked = cut_by_time(asked, keys, ttl_s, rounds)
    start = F.greatest(F.unix_micros("__check.__ts"), F.col("__block") * width)  # what a block took over lies at its start
    checks = cut_by_time(checks.withColumn("__at", start), keys, ttl_s, rounds)
    if rounds:
        cut, cell = F.col("__span") < width, [*series, "__block", "__lo"]
        last = checks.filter(cut).groupBy(*cell).agg(F.max("__check").alias("__check")).withColumn("__asked", F.lit(False))
        block = F.floor(F.col("__lo") / width).alias("__block")
        parts = marks(asked.filter(cut).select(*keys, block, "__lo").distinct()).withColumn("__asked", F.lit(True))
        before = Window.partitionBy(*series, "__block").orderBy("__lo").rangeBetween(Window.unboundedPreceding, -1)
        known = last.unionByName(parts, allowMissingColumns=True).withColumn("__check", F.last("__check", ignorenulls=True).over(before))
        taken = known.filter("__asked AND __check IS NOT NULL").select(*cell, "__check")
        checks = checks.select(*cell, "__check").unionByName(taken)
    cell = [*keys, "__lo"]
    hot = checked_broadcast(hot_salts(asked, cell, rows_per_task * SALTED))
    salts = F.coalesce("__salts", F.lit(1))
    drop = ["__salts", "__span", "__at", "__block"]
    asked = join_on(asked, hot, cell).withColumn(  # null-safe: requests without a backend or time are salted too
        "__salt", F.pmod(F.xxhash64("__row"), salts).cast("int")
    )
    checks = join_on(checks, hot, cell).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return asked.drop(*drop, "__row"), checks.withColumn("__ts", F.col("__check.__ts")).drop(*drop)


def health_asof(
    requests: DataFrame,
    health: DataFrame,
    ttl_s: int = 60,
    unknown: str = "up",
    keys: tuple[str, ...] = ("request_id",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """As-of join: latest check of the request's backend at or before its time, within the TTL.

    Time is cut into TTL-long blocks: a fresh check lies in the block of the request or in
    the one before, so each block only takes over the last check of its predecessor.
    Blocks with very many requests are cut finer by time (``in_cells``), so the work grows with
    the rows, however many requests and checks a block has.

    Adds ``checked_at`` (NULL when unknown or expired) and ``up``.
    """
    width = int(ttl_s) * 1_000_000
    micros = F.unix_micros("__ts")
    asked = requests.select(*keys, "backend", F.col("ts").cast("timestamp").alias("__ts"))
    asked = asked.withColumns({"__at": micros, "__row": F.struct(*keys)})
    checks = recent_checks(health, ttl_s).select("backend", "__block", F.struct("__ts", "up").alias("__check"))
    asked, checks = in_cells(asked, checks, ["backend"], ["backend"], lambda parts: parts, ttl_s, rows_per_task)
    timeline = asked.withColumn("__kind", F.lit(1)).unionByName(checks.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    order = (
        Window.partitionBy("backend", "__lo", "__salt")
        .orderBy("__ts", "__kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = timeline.withColumn("__check", F.last("__check", ignorenulls=True).over(order)).filter("__kind = 1")
    fresh = F.unix_micros("__check.__ts") >= micros - width
    return seen.select(
        *keys,
        "backend",
        F.col("__ts").alias("ts"),
        F.when(fresh, F.col("__check.__ts")).alias("checked_at"),
        _trusted(F.when(fresh, F.col("__check.up")), unknown).alias("up"),
    )


def first_trusted(states: list[Column], at: Column, ttl_s: int, unknown: str) -> Column:
    """(pos, backend) of the first backend of ``__chain`` that is up; ``states`` are the latest checks (__ts, up) by position."""
    found = []
    for pos, check in enumerate(states):
        fresh = F.unix_micros(check["__ts"]) >= F.unix_micros(at) - int(ttl_s) * 1_000_000
        up = _trusted(F.when(fresh, check["up"]), unknown)
        backend = F.struct(F.lit(pos).alias("pos"), F.get("__chain", F.lit(pos)).alias("backend"))
        found.append(F.when((F.size("__chain") > pos) & up, backend))
    none = F.lit(None).cast("struct<pos:int,backend:string>")
    return F.coalesce(*found, none)


def resolve_backends_asof(
    decisions: DataFrame,
    routes: DataFrame,
    health: DataFrame,
    ttl_s: int = 60,
    unknown: str = "up",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Like ``resolve_backends``, with the health each backend had at the request's time (``ts``).

    Every row is resolved for itself, whatever its id: a row meets the checks of all backends of its route in one timeline per
    route and TTL-long block, in which the latest check of each position is carried along. The rows are written once
    (checkpoint), as they are counted first to cut the timelines that many rows share by time.
    """
    ensure_checkpoint_dir(decisions.sparkSession)
    written = decisions.withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    chains = checked_broadcast(routes.select(F.col("label").alias("__route"), F.col("backends").alias("__chain")))
    longest = routes.agg(F.max(F.size("backends"))).first()[0] or 0
    asked = written.join(chains, F.col("label") == F.col("__route"), "left").withColumn("__ts", F.col("ts").cast("timestamp"))
    asked = asked.withColumn("__at", F.unix_micros("__ts"))

    tried = checked_broadcast(chains.select("__route", F.posexplode("__chain").alias("__pos", "backend")))
    checks = recent_checks(health, ttl_s).join(tried, "backend")
    checks = checks.select("__route", "__pos", "__block", F.struct("__ts", "up").alias("__check"))

    def marks(parts: DataFrame) -> DataFrame:
        return parts.join(tried.select("__route", "__pos"), "__route")

    asked, checks = in_cells(asked, checks, ["__route"], ["__route", "__pos"], marks, ttl_s, rows_per_task)
    both = asked.withColumn("__kind", F.lit(1)).unionByName(checks.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy("__route", "__lo", "__salt").orderBy("__ts", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = {
        f"__state{pos}": F.last(F.when(F.col("__pos") == pos, F.col("__check")), ignorenulls=True).over(order) for pos in range(longest)
    }
    seen = both.withColumns(states).filter("__kind = 1") if states else asked
    best = seen.withColumn("__best", first_trusted([F.col(name) for name in states], F.col("__ts"), ttl_s, unknown))
    resolved = best.withColumns(
        {"backend": F.col("__best.backend"), "fallback_used": F.col("__best.pos") > 0, "__known": F.col("__route").isNotNull()}
    )
    return with_error(resolved, F.col("__known")).select(
        *[c for c in decisions.columns if c not in ("backend", "fallback_used")], "backend", "fallback_used"
    )

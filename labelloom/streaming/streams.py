"""Structured Streaming forms of scoring and routing; the batch functions are reused as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.datasets import non_blank
from ..operators.health import backend_status, resolve_backends, with_error
from ..operators.routing import Step, route
from .asof import NO_TIME, AsofBlocks, state_store_ready

#: JSON that keeps every value of a row.
_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


BLOCK_TTLS = 4  # TTLs of a key of the state: a quarter of the checks is in two of them


def _sink(df: DataFrame, path: str, checkpoint: str, fmt: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def classify_lines(
    lines: DataFrame, predict: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    fmt: str = "json", once: bool = False,
) -> StreamingQuery:
    """One label for every non-blank line of a stream; ``predict`` must be stateless."""
    return _sink(predict(non_blank(lines)), path, checkpoint, fmt, once)


def route_stream(
    requests: DataFrame, steps: list[Step], path: str, checkpoint: str, fmt: str = "json", once: bool = False
) -> StreamingQuery:
    """Decisions for a stream of requests."""
    return _sink(route(requests, steps), path, checkpoint, fmt, once)


def route_stream_with_health(
    requests: DataFrame,
    steps: list[Step],
    routes: DataFrame,
    read_health: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    now: Callable[[], Column] = F.current_timestamp,
    ttl_s: int = 60,
    unknown: str = "up",
    once: bool = False,
) -> StreamingQuery:
    """Route a stream; every micro-batch reads the health table anew.

    Batches go to ``batch_id=<n>`` folders, so a repeated batch overwrites itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        status = backend_status(read_health(batch.sparkSession), now(), ttl_s, unknown)
        decided = resolve_backends(route(batch, steps), routes, status, unknown=unknown)
        decided.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def asof_rows(decisions: DataFrame, health: DataFrame, routes: DataFrame, ttl_s: int, salts: int) -> tuple[DataFrame, StructType]:
    """Requests and checks with the key (``__route, __block, __salt``) in which they meet, and the schema of the payload of a request."""
    chains = routes.select(F.col("label").alias("__route"), F.col("backends").alias("__chain"))
    held = decisions.join(chains, F.col("label") == F.col("__route"), "left")
    payload = F.to_json(F.struct(*held.columns), _EXACT)
    ttl = int(ttl_s) * 1_000_000
    width = F.lit(BLOCK_TTLS * max(ttl, 1))
    at = F.unix_micros("__ts")
    asked = held.withColumn("__ts", F.col("ts").cast("timestamp")).select(
        F.coalesce("__route", F.lit("")).alias("__route"),
        F.coalesce(F.floor(at / width), F.lit(0)).alias("__block"),
        F.pmod(F.xxhash64(payload), F.lit(salts)).cast("int").alias("__salt"),
        "__ts",
        F.lit(True).alias("asked"),
        F.coalesce(F.size("__chain"), F.lit(0)).alias("size"),
        F.lit(-1).alias("pos"),
        F.lit(-1).alias("up"),
        payload.alias("payload"),
    )
    tried = chains.select("__route", F.posexplode("__chain").alias("pos", "backend"))
    checks = health.select("backend", F.col("checked_at").cast("timestamp").alias("__ts"), "up").join(tried, "backend")
    blocks = F.sequence(F.floor(at / width), F.floor((at + ttl) / width))
    checks = checks.withColumn("__block", F.explode(blocks)).select(
        "__route", "__block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"), "__ts", F.lit(False).alias("asked"),
        F.lit(0).alias("size"), "pos", F.coalesce(F.col("up").cast("int"), F.lit(-1)).alias("up"), F.lit(None).cast("string").alias("payload"),
    )
    return asked.unionByName(checks).withColumn("at", F.coalesce(at, F.lit(NO_TIME))), held.schema


def resolve_stream_asof(
    decisions: DataFrame,
    health: DataFrame,
    routes: DataFrame,
    ttl_s: int = 60,
    delay_s: int = 10,
    unknown: str = "up",
    salts: int = 1,
) -> DataFrame:
    """``resolve_backends_asof`` for streams of decisions (with ``ts``) and checks: the same rows, however the streams are cut.

    Both streams are one in event time: a request waits until the watermark, ``delay_s`` behind the latest row, has passed its time, and is
    then resolved with the checks of its route's backends up to its time. A key is a route and a block of ``BLOCK_TTLS`` TTLs, so past times are spread over
    many keys; a check within a TTL of its block's end is in the next block too. The state of a key has the requests that wait and the checks
    of one TTL before the watermark. With ``salts``, for more requests of a route at a time than one task can take, a key has one of so many shares of them, and
    every check is copied to each. Rows that come later than ``delay_s`` are dropped, as in every
    watermark. Rows without a known route do not wait. ``routes`` is a static table of labels and backends.
    """
    state_store_ready(decisions.sparkSession)
    columns = [c for c in decisions.columns if c not in ("backend", "fallback_used")]
    rows, schema = asof_rows(decisions.select(*columns), health, routes, ttl_s, salts)
    rows = rows.withWatermark("__ts", f"{int(delay_s)} seconds")
    found = rows.groupBy("__route", "__block", "__salt").transformWithStateInPandas(
        AsofBlocks(int(ttl_s) * 1_000_000, unknown), "payload string, pos int", "Append", "EventTime"
    )
    opened = found.select("pos", F.from_json("payload", schema, _EXACT).alias("row")).select("pos", "row.*")
    resolved = opened.withColumns({"backend": F.get("__chain", F.col("pos")), "fallback_used": F.col("pos") > 0})
    return with_error(resolved, F.col("__route").isNotNull()).select(*columns, "backend", "fallback_used")


def route_stream_asof(
    requests: DataFrame, health: DataFrame, steps: list[Step], routes: DataFrame, path: str, checkpoint: str,
    ttl_s: int = 60, delay_s: int = 10, unknown: str = "up", salts: int = 1, fmt: str = "parquet", once: bool = False,
) -> StreamingQuery:
    """Route a stream of requests with the health that their backends had at their times, read from a stream of checks."""
    decided = resolve_stream_asof(route(requests, steps), health, routes, ttl_s, delay_s, unknown, salts)
    return _sink(decided, path, checkpoint, fmt, once)

"""Vector tables as blocks, and the join of query blocks with vector blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
BLOCK_BYTES = 4_000_000


def usable(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(id, vector) with DOUBLE components. Rows with a null id, null or empty vector, or null or non-finite
    components are left out, and zero vectors unless ``zero``. Of rows with one id the least vector stays."""
    x = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), x.alias("vector")).filter(F.col("id").isNotNull())
    rows = rows.filter((F.size("vector") > 0) & F.forall("vector", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    if not zero:
        rows = rows.filter(F.exists("vector", lambda v: v != 0.0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def block(width: int):
        ids, rows = zip(*held.pop(width), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([width], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
             pa.array([np.array(rows, np.float64).tobytes()], pa.binary())],
            ["width", "ids", "data"],
        )

    for batch in batches:
        for one, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = vector.values.to_numpy(zero_copy_only=False)
            rows = held.setdefault(len(values), [])
            rows.append((one, values))
            if len(rows) >= max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * len(values)))):
                yield block(len(values))
    for width in list(held):
        yield block(width)


def blocks(rows: DataFrame) -> DataFrame:
    """(block, width, ids, data): rows in blocks of bounded size, each of vectors of one width."""
    packed = rows.mapInArrow(_pack, "width int, ids binary, data binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], np.float64).reshape(len(ids), row["width"])


def tile_join(queries: DataFrame, vectors: DataFrame, search: Callable, k: int) -> DataFrame:
    """Every query block with every vector block of its width; (query_id, vec_id, score) of each query's best.

    ``search(state, query row, vector row)`` returns the new state of a query block: (ids, scores, real) arrays of k columns;
    slots that are not ``real`` are empty, whatever their id and score.
    A task streams over its tiles and holds one at a time; the vector blocks of a query block are dealt over many
    tasks. The best of the tasks are then merged by query.
    """
    parts = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    side = queries.select(F.struct("block", "width", "ids", "data").alias("q"), F.col("width"))
    share = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    other = vectors.select(F.struct("block", "width", "ids", "data").alias("v"), "width", share.alias("share"))
    tiles = side.join(other, "width")  # blocks, not rows
    tiles = tiles.select("share", F.col("q.block").alias("query_block"), "q", "v")
    dealt = tiles.repartition("query_block", "share").sortWithinPartitions("query_block", "share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, ids = None, None, None

        def best():
            found, scores, real = state
            query = np.repeat(ids, real.sum(1))
            return pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(found[real]), pa.array(scores[real])], ["query_id", "vec_id", "score"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["query_block"] != at:
                    if at is not None:
                        yield best()
                    at, state = row["query_block"], None
                    ids = np.frombuffer(row["q"]["ids"], np.int64)
                state = search(state, row["q"], row["v"])
        if at is not None:
            yield best()

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def merged(state, n: int, k: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray):
    """Best k per row of the state and of new entries (row, id, score): by score, then by smaller id."""
    if state is None:
        state = (np.full((n, k), -1, np.int64), np.full((n, k), -np.inf), np.zeros((n, k), bool))
    if not len(rows):
        return state
    old, known, real = state
    touched = np.unique(rows)
    place = np.full(n, -1)
    place[touched] = np.arange(len(touched))
    a = np.concatenate([np.repeat(touched, k), rows])
    b = np.concatenate([old[touched].ravel(), ids])
    c = np.concatenate([known[touched].ravel(), scores])
    d = np.concatenate([real[touched].ravel(), np.ones(len(rows), bool)])
    order = np.lexsort((b, ~d, -c, a))
    a, b, c, d = a[order], b[order], c[order], d[order]
    first = np.searchsorted(a, touched)
    at = np.arange(len(a)) - first[place[a]]
    keep = at < k
    old, known, real = old.copy(), known.copy(), real.copy()
    old[a[keep], at[keep]] = b[keep]
    known[a[keep], at[keep]] = c[keep]
    real[a[keep], at[keep]] = d[keep]
    return old, known, real

"""Nearest neighbours by inner product: block matrix join on int8 with error bounds.

Every vector is written as scale * int8 + rest. The int8 product of a tile approximates the inner products; the norms of
vectors and rests bound the error of each. Pairs whose upper bound reaches the k-th lower bound of their query survive and
are computed anew in double precision, term after term; a heap for each query keeps the best over tiles. No pair
that belongs to the result is lost, so recall is 1.

Left out: rows with a null id, null or empty vectors, zero vectors, null or non-finite components. Vectors are
compared with those of equal width only. Equal scores: smaller id first. Of rows with one id the least vector stays. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .vectors import blocks, merged, opened, tile_join, usable

QUERY_ROWS = 512  # of a block that meet a vector block at once
EXACT_WIDTH = 1024  # so many products of int8 sum up without error in float32


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32), scale, norm of scale * values, norm of the rest."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1  # subnormal components
    q = np.rint(x / scale[:, None])
    near = q * scale[:, None]
    return q.astype(np.float32), scale, np.linalg.norm(near, axis=1), np.linalg.norm(x - near, axis=1)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT_WIDTH):
        out += a[:, d : d + EXACT_WIDTH] @ b[:, d : d + EXACT_WIDTH].T
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _search(k: int):
    def search(state, query: dict, vector: dict):
        query_ids, x = opened(query)
        ids, y = opened(vector)
        q8, q_scale, q_near, q_rest = quantised(x)
        v8, v_scale, v_near, v_rest = quantised(y)
        for lo in range(0, len(x), QUERY_ROWS):
            part = slice(lo, lo + QUERY_ROWS)
            near = int8_product(q8[part], v8) * q_scale[part, None] * v_scale
            # |<q, v> - <q~, v~>| <= |q~||rest of v| + |rest of q||v|
            error = q_near[part, None] * v_rest + q_rest[part, None] * (v_near + v_rest)
            error = error * (1 + 1e-9) + 1e-12 * q_near[part, None] * v_near
            near[query_ids[part, None] == ids] = -np.inf
            low = near - error
            floor = np.full(len(low), -np.inf)
            if low.shape[1] > k:
                floor = np.partition(low, -k, axis=1)[:, -k]
            if state is not None:  # the heap's k-th score
                floor = np.maximum(floor, state[1][part, -1])
            row, column = np.nonzero((near + error >= floor[:, None]) & (near > -np.inf))
            score = exact_products(x[row + lo], y[column])
            state = merged(state, len(x), k, row + lo, ids[column], score)
        return state

    return search


def nearest(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows with the largest inner products, for each query row.

    ``is_query`` is a condition on ``id``. Queries are no candidates of their own.
    """
    rows = materialize(usable(df, id_col, vector_col, zero=False), "vectors")
    vectors = materialize(blocks(rows), "blocks")
    queries = materialize(blocks(rows.filter(is_query)), "queries")
    found = tile_join(queries, vectors, _search(k), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

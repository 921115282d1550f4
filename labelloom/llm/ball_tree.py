"""Exact search by integer inner product: ball trees with branch and bound.

Components become ``floor(factor * x)``. Every shard (block of vectors) gets a ball tree; a node's upper bound for a query is
<query, centre> + |query| * radius. The tree is walked from the root, branches below the query's k-th score so far are
cut, and the remaining leaves are taken in the order of their bounds until the next bound is below the k-th score. That score
is shared: it starts from one shard that every query meets first, and goes on from shard to shard of a task.

Left out: rows with a null id, null or empty vectors, null or non-finite components; zero vectors take part. Vectors are
compared with those of equal width only. Equal scores: smaller id first. Of rows with one id the least vector stays. An empty
table gives no rows; other columns are ignored. Scores must stay below 2**53.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .vectors import blocks, merged, opened, tile_join, usable

LEAF = 64


class BallTree:
    """Nodes in rows: children, centre, radius; the members of a leaf are a range of ``order``."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.children, self.ranges, centres, radii = [], [], [], []
        todo = [(0, len(points), None)]
        while todo:
            lo, hi, parent = todo.pop()
            node = len(self.ranges)
            if parent is not None:
                self.children[parent].append(node)
            own = points[self.order[lo:hi]]
            centre = own.mean(0)
            away = np.linalg.norm(own - centre, axis=1)
            self.ranges.append((lo, hi))
            self.children.append([])
            centres.append(centre)
            radii.append(away.max())
            if hi - lo > LEAF and away.max() > 0:
                pole = own[away.argmax()]  # the two far ends of the ball
                other = own[np.linalg.norm(own - pole, axis=1).argmax()]
                side = own @ (other - pole)
                self.order[lo:hi] = self.order[lo:hi][np.argsort(side, kind="stable")]
                mid = (lo + hi) // 2
                todo += [(lo, mid, node), (mid, hi, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(queries, axis=1)
        bound = queries @ self.centres.T + norms[:, None] * self.radii
        return bound + 1e-9 * (1 + np.abs(bound) + norms[:, None] * np.linalg.norm(self.centres, axis=1))


def search_tree(tree: BallTree, points: np.ndarray, ids: np.ndarray, state, queries: np.ndarray, own: np.ndarray, k: int):
    """Merge the best of one shard into ``state`` (ids, scores, real), whose last scores are the bounds to beat."""
    state = merged(state, len(queries), k, *(np.zeros(0, np.int64),) * 3)
    bound = tree.bounds(queries)
    alive = np.zeros(bound.shape, bool)
    alive[:, 0] = bound[:, 0] >= state[1][:, -1]
    for node, children in enumerate(tree.children):  # parents come before their children
        for child in children:
            alive[:, child] = alive[:, node] & (bound[:, child] >= state[1][:, -1])
    leaves = np.array([i for i, c in enumerate(tree.children) if not c])
    bound = np.where(alive[:, leaves], bound[:, leaves], -np.inf)
    turn = np.argsort(-bound, axis=1, kind="stable")
    for step in range(len(leaves)):  # each query takes its next leaf
        leaf = turn[:, step]
        value = np.take_along_axis(bound, leaf[:, None], 1)[:, 0]
        open_rows = np.flatnonzero((value > -np.inf) & (value >= state[1][:, -1]))
        if not len(open_rows):
            break
        rows, found, scores = [], [], []
        for which in np.unique(leaf[open_rows]):
            lo, hi = tree.ranges[leaves[which]]
            members = tree.order[lo:hi]
            askers = open_rows[leaf[open_rows] == which]
            score = queries[askers] @ points[members].T
            good = (score >= state[1][askers, -1][:, None]) & (own[askers][:, None] != ids[members])
            a, b = np.nonzero(good)
            rows.append(askers[a])
            found.append(ids[members][b])
            scores.append(score[a, b])
        state = merged(state, len(queries), k, *map(np.concatenate, (rows, found, scores)))
    return state


def _search(k: int, factor: int, first: dict):
    def search(state, query: dict, vector: dict):
        own, x = opened(query)
        ids, y = opened(vector)
        x, y = np.floor(factor * x), np.floor(factor * y)
        start = first.value.get(query["width"])
        if state is None and start is not None and start["block"] != vector["block"]:
            # scores over the shared shard are only bounds here: the shard is searched in its own tile
            _, scores, _ = search_tree(BallTree(s := np.floor(factor * opened(start)[1])), s, opened(start)[0], None, x, own, k)
            state = (np.full(scores.shape, -1, np.int64), np.full(scores.shape, -np.inf), np.zeros(scores.shape, bool))
            floor = scores[:, -1]
        else:
            floor = np.full(len(x), -np.inf)
        held = merged(state, len(x), k, *(np.zeros(0, np.int64),) * 3)
        padded = (held[0], np.where(held[2], held[1], np.maximum(held[1], floor[:, None])), held[2])
        return search_tree(BallTree(y), y, ids, padded, x, own, k)

    return search


def top_inner_products(
    df: DataFrame, is_query: Column, k: int, factor: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long): each query row's ``k`` highest scores over all other rows."""
    spark = df.sparkSession
    rows = materialize(usable(df, id_col, vector_col, zero=True), "vectors")
    shards = materialize(blocks(rows), "shards")
    queries = materialize(blocks(rows.filter(is_query)), "queries")
    widths = [r.width for r in queries.select("width").distinct().limit(16).collect()]
    first = {}
    for width in widths:  # one block of bounded size for each of the first widths
        first[width] = shards.filter(F.col("width") == width).first().asDict()
    found = tile_join(queries, shards, _search(k, factor, spark.sparkContext.broadcast(first)), k)
    return found.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score")
    )

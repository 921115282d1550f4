"""Connected components of a table of links, in joins that survive hubs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialize


def _towards_minimum(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours of every node to the least of them.

    The minimum is an aggregate and comes back by a join: no task gathers a hub's neighbours,
    and the join may split a hub's rows over tasks.
    """
    both = edges if smaller_only else edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    pulled = both.join(least, "a")
    if smaller_only:  # b < a throughout
        out = pulled.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionAll(least.select("a", F.col("m").alias("b")))
    else:
        out = pulled.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a > b").distinct()


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is the least node reachable.

    Alternates linking larger neighbours and smaller neighbours to the least one until nothing
    changes; every round is written, so that no lineage grows. Nulls and self links are left out.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, label)
    mark = None
    while True:
        edges = materialize(_towards_minimum(_towards_minimum(edges, False), True), label)
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            break
        mark = tuple(row)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components by alternating large-star and small-star steps, each a Spark aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagework.plans.materialize import materialize


def _with_least(neighbours: DataFrame) -> DataFrame:
    """``u, v, m``: m is the least of u and all its v. The minimum combines before the shuffle, and
    a node with very many neighbours is one skewed join key, which adaptive execution splits."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m"))
    return neighbours.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return linked.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of whole numbers to ``node, root``, root being the least node it reaches.

    Nodes without an edge to another node do not come out. Every round is written to the shared
    folder; the rounds needed grow with the logarithm of the longest chain.
    """
    now = materialize(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        now = materialize(_small_star(_large_star(now)), "edges")

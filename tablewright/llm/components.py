"""Connected components by alternating large-star and small-star steps; every step is a written table.

A node with a large share of all edges (a hub) is not joined by shuffle: the smallest neighbours of hubs, of which there are few by
definition, are broadcast, and their edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stage
from .hot import HOT_SHARE


def _with_low(edges: DataFrame, low: Column, kept: Column, total: int) -> tuple[DataFrame, DataFrame]:
    """The kept edges with ``low`` of their ``a``, and ``a, low`` of every ``a``."""
    lows = edges.groupBy("a").agg(low.alias("low"), F.count(F.lit(1)).alias("n"))
    is_hub = F.col("n") * HOT_SHARE >= total
    hubs = F.broadcast(lows.where(is_hub).select("a", "low"))
    some = edges.where(kept)
    of_hubs = some.join(hubs, "a")
    others = some.join(F.broadcast(lows.where(is_hub).select("a")), "a", "left_anti").join(lows.where(~is_hub).select("a", "low"), "a")
    return of_hubs.unionByName(others), lows.select("a", "low")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = _with_low(both, F.least(F.min("b"), F.first("a")), F.col("b") > F.col("a"), 2 * total)
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined, lows = _with_low(down, F.min("b"), F.lit(True), total)
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lows.select("a", F.col("low").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of each node that has an edge in ``a, b``."""
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    was = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == was or not seen[0]:
            break
        was = seen
        now = stage(_large_star(now, seen[0]).where("a <> b"), "edges")
        now = stage(_small_star(now, seen[0]).where("a <> b").distinct(), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

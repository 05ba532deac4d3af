"""Connected components of an edge table, as a Spark loop.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round is two aggregates and two
joins on the node; a hub's edges are an aggregate (combined map-side) and a join
that adaptive execution splits, never a collected list. Rounds end when the edge
table no longer changes; a path of n nodes takes O(log^2 n) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notchline.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another node; ``root`` is the
    smallest node of its component. ``edges`` may hold repeats, loops, either
    direction and nulls (ignored); an empty table gives an empty result."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    current, seen = stored(e, "edges"), None
    while True:
        following = stored(_small_star(_large_star(current)), "edges")
        mark = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_stored(current)
        current = following
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

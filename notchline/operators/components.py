"""Connected components of an edge table, by large-star and small-star rounds.

Every round (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) hangs
each node's greater neighbours on its least one, then its lesser ones: two aggregates and two
joins on the node, no list of a node's neighbours. Chains shrink by their square root at
least, so few rounds are needed. Each round's edges are written to the
shared folder and read back, so the lineage stays short; the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notchline.session import scratch_path
from notchline.sources import folders


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _round(edges: DataFrame) -> DataFrame:
    """Edges ``(hi, lo)`` with hi > lo, after one large-star and one small-star."""
    ends = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))  # both directions
    least = ends.groupBy("hi").agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
    large = ends.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
    low = large.groupBy("hi").agg(F.min("lo").alias("m"))
    hung = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return hung.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node with an edge to another; ``root`` is the least
    node reachable from it. Loops, repeats, nulls and either direction are allowed."""
    spark = edges.sparkSession
    ordered = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    path = scratch_path(spark, "edges")
    now, before = _written(ordered, path), None
    while True:
        after_path = scratch_path(spark, "edges")
        after = _written(_round(now), after_path)
        state = after.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        folders.delete(spark, path)
        now, path = after, after_path
        if state == before:
            break
        before = state
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )

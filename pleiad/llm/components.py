"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, release


def _marks(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of edges (a, b) with the smallest node that it reaches, itself included.

    Nodes are longs. Edges may repeat and go either way; loops count for nothing, so a node that has no other
    edge is not returned, and an empty table gives an empty one. The star steps end when an edge table repeats;
    the driver sees only its count and checksum. Minima are aggregated before the shuffle, and AQE splits the
    join of a hub's edges.
    """
    now = checkpointed(edges.select("a", "b").where("a <> b").distinct())
    marks = _marks(now)
    while marks[0]:
        now, before = checkpointed(_small_star(_large_star(now))), now
        release(before)
        if (after := _marks(now)) == marks:
            break
        marks = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

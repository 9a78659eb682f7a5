"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (itself included)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").where("b > m")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return least.select(F.col("m").alias("a"), "b").union(moved).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (a, b) of longs; root is the least node reachable.

    Rounds go on until the edges stay the same, which both steps are known to reach: every round that changes
    an edge gives some node a smaller parent. Each round writes its edges to the shared folder, so the lineage stays
    short and lost executors do no harm. Hot nodes are pre-aggregated by min and joined on joins that the engine can
    split. Self links and repeated rows do not matter; an empty table gives no rows.
    """
    now = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), "edges")
    mark = F.struct(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b")))
    seen, state = None, now.agg(mark).first()[0]
    while state != seen:
        now = materialize(_small_star(_large_star(now)), "edges")
        seen, state = state, now.agg(mark).first()[0]
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())

"""Connected components of links between 64-bit node ids, by hooking to smaller neighbours.

Each round is two joins and two aggregations; lineage is cut by a table in the shared folder.
A node with very many links is one hot join key, which adaptive execution splits, and one
aggregated key, which is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.sources.scratch import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """From links (`a`, `b`) to rows (`node`, `root`): each node with the smallest node it reaches.

    Nodes without links are absent. Loops (`a` = `b`) and repeats are ignored; no link, no row.
    Alternating large-star and small-star rounds end when no link changes.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    for _ in range(max_rounds):
        # Large star: neighbours above a node hook to the smallest of the node and its neighbours.
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        large = materialize(large, "large-star")
        # Small star: a node and its smaller neighbours hook to the smallest of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = materialize(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct(), "small-star")
        same = (
            small.withColumn("side", F.lit(1)).unionByName(edges.withColumn("side", F.lit(-1)))
            .groupBy("a", "b").agg(F.sum("side").alias("d")).where("d <> 0").isEmpty()
        )
        edges = small
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.storage import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node of ``src``, ``dst``.

    Each round hangs the greater neighbours of a node on its smallest neighbour or itself
    (large star), then a node and its smaller neighbours on the smallest (small star). The links shrink to stars in a number of rounds that grows with the
    logarithm of the longest path. A node with many links is no group in memory: the
    minimum is an aggregate with a map-side step, and the join on it is split by adaptive
    execution. Every round is written to the shared folder, which ends the lineage.
    """
    edges = scratch.table(
        links.where("src <> dst")
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct(),
        f"{name}-0",
    )
    step, before = 0, None
    while True:
        step += 1
        edges = scratch.table(_small_star(_large_star(edges)), f"{name}-{step}")
        state = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.hash("a", "b").cast("long")).alias("h"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("x"),
        ).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(heads)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    greater = both.where("b > a").join(least, "a")
    return greater.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

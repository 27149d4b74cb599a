"""Connected components of an edge table, as joins and sums over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import stash

MAX_ROUNDS = 60


def _smallest(directed: DataFrame) -> DataFrame:
    """For each node u of (u, v): m, the smallest of itself and its neighbours.

    Written, so that the join with the edges is of two plain shuffles: a node with very many edges is then
    split over tasks.
    """
    return stash(directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v), u != v; root is the smallest node of its component.

    Large-star and small-star steps in turn (Kiveris et al. 2014) until nothing changes: every edge then
    goes from a node to the root. Each round is written to the shared folder; sums of hashes tell whether
    it changed. Nodes without edges don't occur; an empty table gives no rows.
    """
    edges = stash(edges.select("u", "v").distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = stash(_small_star(_large_star(edges)).distinct().where("u != v"))
        hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
        now = edges.agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

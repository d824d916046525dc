"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al. 2014). Edges (u, v) run from a node to a lesser
one. A hot node's neighbours meet in aggregates with partial results, and in joins
whose rows go on to a shuffle, so that Spark can split a skewed partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node that has a lesser one."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbourhood."""
    # keyed by a struct, the aggregate is shuffled once more: Spark splits the
    # skewed partitions of a join only if both its sides come from a shuffle
    least = _least(edges).select(F.struct(F.col("u").alias("node")).alias("key"), "m")
    return edges.join(least, F.struct(F.col("v").alias("node")) == F.col("key"), "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of these."""
    moved = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return edges.join(_least(edges), "u").select(F.inline(moved)).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node has one edge to a lesser node, or only edges from greater ones."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return ends.groupBy("x").agg((F.sum("up") + F.max("down")).alias("n")).where("n > 1").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge (u, v); the component is
    its least node. Edges to null or to the node itself are ignored."""
    now = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        if _settled(now):
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        now = checkpointed(_small_star(_large_star(now)))
    raise RuntimeError(f"the components did not settle in {rounds} rounds")

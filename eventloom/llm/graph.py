"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), where component is the least node reachable.

    Each round hangs all neighbours of a node on the least one, first those above the
    node, then those not above it; paths halve, so rounds grow with the logarithm of the
    longest one. Each round is stored: a lost executor costs one round's tasks. A node's
    least neighbour is a partial aggregate, joined back by a shuffle that Spark may
    split at skewed nodes, so no node's neighbours are gathered in a task.
    """
    e = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _min_neighbour(both).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
        # Large star: neighbours above a node go to its least neighbour (or itself).
        large = both.where(F.col("v") > F.col("u")).join(m, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        s = _min_neighbour(large).select(F.col("u").alias("at"), "m")
        small = large.join(s, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(s.select(F.col("at").alias("u"), F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        e = stored(small, "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

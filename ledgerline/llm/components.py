"""Connected components by alternating large-star and small-star steps.

Every round is a few equi-joins and partial aggregates over the edges; nothing
of the graph reaches the driver but two counts. The rounds end when every node
has one edge up to a node that has none: a forest of stars. What is grouped by
a key, and so is even, comes in as many partitions as its rows need
(``EDGES_AT_ONCE`` each, but no fewer than there are cores), not in as many as
the session shuffles into: a round's tasks, and the files they leave, go with
the edges. Joins keep the session's number, so that a hot node can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import checkpointed

EDGES_AT_ONCE = 200_000


def _large_star(e: DataFrame, parts: int) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # cut here, so that the join deals both of its sides itself: only then can
    # adaptive execution split the tasks of a node with very many edges
    least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(parts))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, parts: int) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    onward = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onward.unionByName(least.select("u", F.col("m").alias("v")).coalesce(parts))


def _edges_and_bends(e: DataFrame, parts: int):
    """(edges, bends): how many edges there are, and how many nodes have two
    edges up, or an edge up and one from below."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("below")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("below")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("below").alias("below")).coalesce(parts)
    return nodes.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("edges"),
                     F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("below") == 1))).alias("bends")).first()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge to another one; the
    component is its least node. Edges may repeat and go either way."""
    e = checkpointed(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                     .filter("u <> v").distinct())
    parts = max(1, e.rdd.getNumPartitions())
    while True:
        now = _edges_and_bends(e, parts)
        if not now.bends:
            break
        parts = max(e.sparkSession.sparkContext.defaultParallelism, -(-now.edges // EDGES_AT_ONCE))
        e = e.coalesce(parts)
        e = checkpointed(_small_star(_large_star(e, parts).distinct().coalesce(parts), parts).distinct().coalesce(parts))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

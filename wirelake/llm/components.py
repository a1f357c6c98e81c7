"""Connected components by alternating stars, as joins of edges with their least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wirelake.llm import common

MOST_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to the least one and the node."""
    around = _both_ways(edges)
    if not large:
        around = around.filter("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = around.filter("b > a") if large else around
    moved = linked.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    ``edges`` has the numbers a and b. Each round ends as a written table; rounds grow with the
    logarithm of the longest chain, and end when the edges stay the same.
    """
    now = common.written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = None
    for _ in range(MOST_ROUNDS):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = common.written(_star(_star(now, True), False), "edges")
    else:
        raise RuntimeError(f"edges still change after {MOST_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

"""Connected components by alternating stars; nothing of the graph leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the larger (or the smaller) neighbours of each node to its least neighbour."""
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(flipped) if large else edges
    least = stored(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    joined = around.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and its class, the least node that it is connected with; edges: a, b in any order.

    Nodes without an edge to another have no row. Each round is stored, so no plan grows; the number of
    rounds grows with the logarithm of the longest path.
    """
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 2**40)).first())
    held = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(held)
    while before[0]:
        held = stored(star(star(held, True), False))
        now = mark(held)
        if now == before:
            break
        before = now
    roots = held.select(F.col("b").alias("node")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("class")).unionByName(
        roots.select("node", F.col("node").alias("class"))
    )

"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..tables import settle


def _toward_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step.  larger: every greater neighbour of a node moves to the least of its neighbourhood; else the node and its smaller neighbours do."""
    if larger:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
        least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = around.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Alternate large-star and small-star steps (Kiveris et al., 2014) until every node points at its component's least node.

    edges: columns a, b (long), in any direction.  Returns (node, component) for the nodes that have an edge to another node.
    The only figures that reach the driver are a row count and a checksum.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b")).distinct()
        seen = tuple(mark)
        now = settle(_toward_minimum(_toward_minimum(now, True), False), "edges")

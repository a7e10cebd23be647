"""List ranking: the order of linked elements in their chains and cycles, by pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..tables import settle, sized


def ranked(links: DataFrame) -> DataFrame:
    """(e, chain, closed, rank) from (e, nxt): every element (long) with its successor, null at the end of a chain; no two elements share one.

    Each round doubles how far an element sees: it takes over the successor of its successor, the least element on the way
    and how far that is.  A cycle has been seen whole when no least element changes; in it the least element is the last,
    in a chain the end is.  rank rises along the links and is 0 at the last.  The number of rounds is the logarithm of the
    longest chain, each is one join of the elements that have a successor with all, and only counts and a checksum reach the driver.
    """
    now = settle(links.select("e", "nxt", F.col("e").alias("least"), F.lit(0).cast("long").alias("far"), F.when(F.col("nxt").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.when(F.col("nxt").isNull(), F.col("e")).alias("tail")), "chains")
    seen, jump = None, 1
    while True:
        mark = now.agg(F.count("nxt"), F.sum(F.xxhash64("e", "least").cast("decimal(38,0)")), F.count("*")).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        ahead = now.select(F.col("e").alias("nxt"), F.col("nxt").alias("nxt_"), F.col("least").alias("least_"), F.col("far").alias("far_"), F.col("steps").alias("steps_"), F.col("tail").alias("tail_"))
        lower = F.col("least_") < F.col("least")
        both = now.where("nxt is not null").join(sized(ahead, mark[2]), "nxt", "left")
        moved = both.select("e", F.col("nxt_").alias("nxt"), F.when(lower, F.col("least_")).otherwise(F.col("least")).alias("least"), F.when(lower, jump + F.col("far_")).otherwise(F.col("far")).alias("far"), (F.col("steps") + F.coalesce("steps_", F.lit(0))).alias("steps"), F.coalesce("tail", "tail_").alias("tail"))
        now = settle(moved.unionByName(now.where("nxt is null")), "chains")
        jump *= 2
    closed = F.col("tail").isNull()
    return now.select("e", F.coalesce("tail", "least").alias("chain"), closed.alias("closed"), F.when(closed, -F.col("far")).otherwise(-F.col("steps")).alias("rank"))

"""Mixing sources to target weights by subset-sum over exact document lengths."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..tables import settle
from .rows import key, keyed

WORD = r"[^\x20\x09-\x0D]+"
#: The dynamic programme has so many steps at most, of so many bits together; it starts so many documents before the budget is full.
DP_STEPS, DP_BITS, OPEN = 4096, 1 << 28, 64
GROUP = 256


def spread(counts: list[int], part: int, whole: int, start: float) -> list[int]:
    """part / whole of each count, rounded so that any run of counts is less than one off its share; ``start`` in [0, 1) shifts what is rounded up."""
    first, out, before, upto = int(start * whole), [], 0, 0
    for n in counts:
        upto += n
        now = (part * upto + first) // whole
        out.append(now - before)
        before = now
    return out


def fit(lengths: list[int], counts: list[int], budget: int, seed: int = 7) -> list[int]:
    """How many documents of each length to take so that their words come to ``budget``, or as near below it as found.

    The same share of every length comes first, of the whole budget but the greatest length, which is what rounding may
    exceed it by.  What is left, twice the greatest length at most, is filled with the other documents in seeded order,
    the last of them by a knapsack: a bit for each reachable sum, with the bitmaps kept to trace the documents that make
    up the best sum.  Short and long documents are thus taken alike whatever the budget.
    """
    total = sum(a * n for a, n in zip(lengths, counts))
    budget = max(0, min(budget, total))
    took = [0] * len(lengths)
    order = sorted((i for i, a in enumerate(lengths) if a and counts[i]), key=lambda i: lengths[i])
    if not order or not budget:
        return took
    if budget == total:
        return [n if a else 0 for a, n in zip(lengths, counts)]
    rng = np.random.default_rng(seed)
    for i, n in zip(order, spread([counts[i] for i in order], max(0, budget - lengths[order[-1]]), total, rng.random())):
        took[i] = n
    rest = budget - sum(lengths[i] * took[i] for i in order)
    left = [counts[i] - took[i] for i in order]
    drawn = min(sum(left), rest + DP_STEPS)  # no more than these can be taken or tried
    drawn = rng.permutation(np.repeat(order, spread(left, drawn, sum(left), rng.random()))).tolist()
    upto = list(accumulate(lengths[i] for i in drawn))
    first = max(0, bisect_right(upto, rest) - OPEN)
    for i in drawn[:first]:
        took[i] += 1
        rest -= lengths[i]
    reach, steps, mask = 1, [], (1 << (rest + 1)) - 1
    for i in drawn[first:]:
        if reach >> rest & 1 or len(steps) >= min(DP_STEPS, max(2 * OPEN, DP_BITS // (rest + 1))):
            break
        if lengths[i] <= rest:
            steps.append((i, reach))
            reach = (reach | reach << lengths[i]) & mask
    at = reach.bit_length() - 1
    for i, before in reversed(steps):
        if not before >> at & 1:
            took[i] += 1
            at -= lengths[i]
    return took


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights go round the sources in code-point order, null last.

    A source stops at ``most`` times its size and the rest rises to the level at which all targets together make ``share``
    of all sizes: the greatest of the levels found by leaving out 0, 1, 2 ... of the sources that stop first.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = sources.select("source", "source_size", F.element_at(cycle, (place - 1) % len(weights) + 1).alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    first = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(W.partitionBy()) * share - before) / F.sum("w").over(first.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(W.partitionBy()))
    return s.select("source", "source_size", F.greatest(F.lit(0.0), F.least(F.col("cap"), F.col("level") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, seed: int = 7) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies): how many words the mix takes of each document.

    size is the number of words of the whole text (null: 0).  Each source's documents are all taken as often as the target
    allows, then a subset whose words make up the remaining budget is taken once more: :func:`fit` says how many of each
    length, and of one length the documents with the least seeded hashes are taken (bucketed by hash, so that a length
    shared by very many documents is ranked in many tasks).  Documents without words are never taken.  A null source
    is a source; rows that repeat a doc_id are separate documents with equal rank.  An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = settle(docs.select("doc_id", "source", size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", "source").alias("u")), "sizes")
    lengths = settle(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    goal = settle(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "targets")

    def knapsack(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        pdf = pdf.sort_values("size")
        copies = int(target // whole) if whole else 0
        sizes, counts, rest = pdf["size"].tolist(), pdf["n"].tolist(), round(target - copies * whole)
        met = lambda took: sum(a * t for a, t in zip(sizes, took))
        took = fit(sizes, counts, rest, seed)
        if copies and rest > met(took):  # few documents: give one whole round up, and take each up to twice instead
            twice = fit(sizes, [2 * n for n in counts], rest + whole, seed)
            if met(twice) - whole > met(took):
                copies, took = copies - 1, twice
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "n": pdf["n"], "source_size": whole, "target": target, "copies": copies, "more": took})

    def beside(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        """An inner join on keys that may be null."""
        right = right.withColumnsRenamed({k: f"{k}_" for k in keys})
        return left.join(right, [left[k].eqNullSafe(right[f"{k}_"]) for k in keys]).drop(*[f"{k}_" for k in keys])

    plan = settle(beside(lengths, goal, "source").groupBy("source").applyInPandas(knapsack, "source string, size long, n long, source_size long, target double, copies long, more long"), "plan")
    bucket = F.floor(F.shiftrightunsigned("u", 11) / F.lit(float(1 << 53)) * F.ceil(F.col("n") / GROUP)).cast("long")
    dealt = beside(rows, plan, "source", "size").withColumn("bucket", bucket)
    held = dealt.groupBy("source", "size", "bucket").agg(F.count("*").alias("c"))
    held = held.withColumn("before", F.sum("c").over(W.partitionBy("source", "size").orderBy("bucket")) - F.col("c")).drop("c")
    ranked = beside(dealt, held, "source", "size", "bucket")
    rank = F.row_number().over(W.partitionBy("source", "size", "bucket").orderBy("u", "doc_id")) + F.col("before")
    copies = F.when(F.col("size") > 0, F.col("copies") + (rank <= F.col("more")).cast("long") + (rank + F.col("n") <= F.col("more")).cast("long")).otherwise(F.lit(0)).cast("long")
    out = ranked.select("doc_id", "size", "source_size", "target", copies.alias("copies"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, each as often as it is taken; all columns stay.

    Rows without a doc_id are told apart by their texts; rows that repeat an id are each taken as often as the one of them that is taken most.
    """
    taken = mix(docs.select(key().alias("doc_id"), "source", "text"), **options).where("copies > 0")
    times = taken.groupBy(F.col("doc_id").alias("key")).agg(F.max("copies").alias("copies"))
    return keyed(docs).join(times, "key").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")

"""Sharding by balanced label propagation, in DataFrame operations only.

Documents start in shards of near equal bytes, by hash.  In each round a linked document asks for the shard
that holds most of its neighbours.  The linked bytes of a shard are held to its quota, the mean of all bytes:
for each pair of shards the bytes that go one way are admitted up to those that come the other way plus what
the quota leaves free.  Unlinked documents are ballast, which a last step moves from shards above the mean to
those below; linked ones follow only where ballast is short.  Requests are admitted in hash buckets, never by
ranking a shard's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..tables import settle

#: Fixed numbers of hash buckets: of the start, of each pair of shards in a round, of each shard in the last step, and of each text's rows.
START, PAIR, LAST, COPIES = 16384, 64, 1024, 1024
SLOTS = 256


def _bucket(n: int, *salt: int) -> F.Column:
    return F.pmod(F.xxhash64("node", *[F.lit(x) for x in salt]), F.lit(n)).cast("int")


def _start(nodes: DataFrame, shards: int) -> DataFrame:
    """nodes with a column shard: hash buckets in a row, cut into equal shares of all bytes."""
    sums = nodes.groupBy(_bucket(START, 1).alias("bucket")).agg(F.sum("size").alias("s"))
    middle = F.sum("s").over(W.orderBy("bucket")) - F.col("s") / 2
    cut = settle(sums.select("bucket", F.least(F.floor(middle * shards / F.sum("s").over(W.partitionBy())), F.lit(shards - 1)).cast("int").alias("shard")), "start")
    return nodes.withColumn("bucket", _bucket(START, 1)).join(F.broadcast(cut), "bucket").drop("bucket")


def _wishes(state: DataFrame, ends: DataFrame) -> DataFrame:
    """state (node, size, shard) with wish, the shard of most neighbours where that is another one, and leads, whether all neighbours are greater nodes.

    ends: node and other, each link both ways.
    """
    label = state.select(F.col("node").alias("other"), F.col("shard").alias("wish"))
    votes = ends.join(label, "other").groupBy("node", "wish").agg(F.count("*").alias("n"), F.min("other").alias("least"))
    best = F.max_by("wish", F.struct("n", (F.col("wish") == F.col("shard")).alias("own"), -F.col("wish")))
    found = votes.join(state, "node").groupBy("node", "size", "shard").agg(best.alias("wish"), (F.min("least") > F.col("node")).alias("leads"))
    return found.withColumn("wish", F.when(F.col("wish") != F.col("shard"), F.col("wish")))


def _admitted(wishes: DataFrame, loads: dict[int, float], quota: float, turn: int) -> DataFrame:
    """(shard, wish, bucket) of the requests that the quotas admit.  loads: linked bytes of each shard."""
    sums = wishes.groupBy("shard", "wish", _bucket(PAIR, 3, turn).alias("bucket")).agg(F.sum("size").alias("s"))
    pair = sums.groupBy("shard", "wish").agg(F.sum("s").alias("go"))
    back = pair.select(F.col("shard").alias("wish"), F.col("wish").alias("shard"), F.col("go").alias("come"))
    room = F.create_map(*[x for k, v in loads.items() for x in (F.lit(k), F.lit(max(0.0, quota - v)))])
    pair = pair.join(back, ["shard", "wish"], "left").fillna(0, ["come"]).withColumn("more", F.greatest(F.lit(0), F.col("go") - F.col("come")))
    into = F.sum("more").over(W.partitionBy("wish"))
    free = F.when(F.col("more") > 0, F.least(F.col("more"), F.element_at(room, F.col("wish")) * F.col("more") / into)).otherwise(0.0)
    most = pair.select("shard", "wish", (F.least("go", "come") + free).alias("most"))
    taken = sums.join(most, ["shard", "wish"]).withColumn("s", F.sum("s").over(W.partitionBy("shard", "wish").orderBy("s", "bucket")))
    return taken.where("s <= most").select("shard", "wish", "bucket")


def _moved(state: DataFrame, loads: dict[int, float], quota: float, turn: int) -> DataFrame:
    """state after this turn, as far as the quotas admit wishes: in the first turn of the nodes that do not lead, later of a random half, lest neighbours swap for ever."""
    may = _bucket(2, 2, turn) == 0 if turn else ~F.col("leads")
    asks = F.col("wish").isNotNull() & may
    asking, other = state.where(asks), state.where(~asks)  # only what asks is joined
    go = _admitted(asking, loads, quota, turn).withColumn("goes", F.lit(True))
    went = asking.withColumn("bucket", _bucket(PAIR, 3, turn)).join(F.broadcast(go), ["shard", "wish", "bucket"], "left")
    return went.select("node", "size", F.when(F.col("goes"), F.col("wish")).otherwise(F.col("shard")).alias("shard")).union(other.select("node", "size", "shard"))


def _loads(nodes: DataFrame) -> dict[int, float]:
    return {r.shard: float(r.s) for r in nodes.groupBy("shard").agg(F.sum("size").alias("s")).collect()}


def _evened(nodes: DataFrame, shards: int, salt: int) -> DataFrame:
    """nodes (node, size, shard, linked), moved by hash buckets from shards above the mean to those below it; what is left of the differences is a bucket at most."""
    loads = _loads(nodes)
    mean = sum(loads.values()) / shards
    spans, at, give, have = [], 0.0, {}, 0.0  # of the bytes that leave, in a row by shard: what each low shard gets, and where each high shard's begin
    for k in range(shards):
        if (gap := mean - loads.get(k, 0.0)) > 0:
            spans.append((at, at + gap, k))
            at += gap
        elif gap < 0:
            give[k] = (have, -gap)
            have -= gap
    if not give:
        return nodes
    bucket = _bucket(LAST, 4, salt) + F.when(F.col("linked"), LAST).otherwise(0)
    sums = nodes.where(F.col("shard").isin(list(give))).groupBy("shard", bucket.alias("bucket")).agg(F.sum("size").alias("s"))
    upto = F.sum("s").over(W.partitionBy("shard").orderBy("bucket"))
    begin = F.create_map(*[x for k, v in give.items() for x in (F.lit(k), F.lit(v[0]))])
    most = F.create_map(*[x for k, v in give.items() for x in (F.lit(k), F.lit(v[1]))])
    going = sums.withColumn("upto", upto).where(F.col("upto") - F.col("s") / 2 <= F.element_at(most, F.col("shard")))
    middle = F.element_at(begin, F.col("shard")) + F.col("upto") - F.col("s") / 2
    to = F.coalesce(*[F.when((middle >= a) & (middle < b), F.lit(k)) for a, b, k in spans])
    going = going.select("shard", "bucket", to.alias("to"))
    moved = nodes.withColumn("bucket", bucket).join(F.broadcast(going), ["shard", "bucket"], "left")
    return moved.withColumn("shard", F.coalesce("to", "shard")).drop("bucket", "to")


def propagate(nodes: DataFrame, links: DataFrame, shards: int = 16, rounds: int = 8, slack: float = 0.01) -> DataFrame:
    """(node, size, shard): nodes has node (unique long) and size, links a and b (nodes).

    All rounds are made whatever the input, so that the work follows the links.  What the driver sees is bounded by the number of shards.
    """
    begun = _start(nodes.select("node", "size"), shards)
    ends = settle(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")), "ends")
    state = settle(begun.join(ends.select("node").distinct(), "node", "left_semi"), "linked")
    quota = sum(_loads(begun).values()) / shards * (1 + slack)
    for turn in range(rounds):
        state = settle(_wishes(state, ends), "wishes")
        state = _moved(state, {k: 0.0 for k in range(shards)} | _loads(state), quota, turn)
    moved = state.select("node", F.col("shard").alias("now"))
    placed = begun.join(moved, "node", "left").select("node", "size", F.coalesce("now", "shard").cast("int").alias("shard"), F.col("now").isNotNull().alias("linked"))
    for salt in (0, 1):  # the second time only what the first leaves is moved
        placed = _evened(settle(placed, "whole"), shards, salt)
    return placed.select("node", "size", "shard")


def _placed(rows: DataFrame, shards: int, rounds: int) -> DataFrame:
    """What :func:`shard` gives, and node; rows has node (unique long), doc_id and text."""
    text = F.col("text")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    nodes = settle(rows.select("node", "doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest")), "nodes")
    texts = nodes.where("digest is not null").withColumn("bucket", _bucket(COPIES, 6))
    buckets = texts.groupBy("digest", "bucket").agg(F.min("node").alias("near"), F.count("*").alias("n"))
    first = buckets.groupBy("digest").agg(F.min("near").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    known = buckets.drop("n").join(first, "digest")
    to = F.when(F.col("node") != F.col("near"), F.col("near")).otherwise(F.col("first"))
    links = settle(texts.join(known, ["digest", "bucket"]).select(F.col("node").alias("a"), to.alias("b")).where("a <> b"), "links")
    placed = nodes.drop("digest").join(propagate(nodes, links, shards, rounds).drop("size"), "node")
    n = max(1, -(-nodes.count() // (shards * SLOTS)))
    placed = settle(placed.withColumn("bucket", _bucket(n, 5)), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "bucket", (F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    slot = F.col("before") + F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "node")) - 1
    return placed.join(offsets, ["shard", "bucket"]).select("node", "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shard(docs: DataFrame, shards: int = 16, rounds: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    Rows with equal texts are linked (each to the first of its hash bucket, these to the first of all; never all pairs) and
    drawn into one shard as far as the byte quotas let them; a group larger than a shard is spread over several.  size is the text's UTF-8 bytes plus 1 (null: 1),
    law is ``bytes``; slot numbers a shard's rows from 0 without gaps.  A null text has no checksum and no link.  Repeated rows
    and null doc_ids are placed as rows of their own; other columns are ignored.  An empty table gives an empty result.
    """
    return _placed(docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text"), shards, rounds).drop("node")


def sharded(docs: DataFrame, shards: int = 16, rounds: int = 8) -> DataFrame:
    """``docs`` with all its columns beside those of :func:`shard`; a column of docs with the name of one of these gives way to it.

    Rows are numbered in a written table, so that rows without a doc_id and repeated ones keep their own places.
    """
    rows = settle(docs.select(F.monotonically_increasing_id().alias("node"), F.struct("*").alias("row")), "rows")
    placed = _placed(rows.select("node", "row.doc_id", "row.text"), shards, rounds)
    own = [c for c in placed.columns if c not in ("node", "doc_id")]
    return rows.join(placed.drop("doc_id"), "node").select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in own], *own)

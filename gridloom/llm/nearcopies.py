"""MinHash near-duplicates by an inverted join over signature coordinates.

1. One pass turns each whole text into its set of distinct 5-word shingles and K MinHash
   coordinates.  Texts with equal sets form a class, represented by its least doc_id.
2. Classes are posted under each coordinate value.  A coordinate value of one class only can
   collide with nothing, so a class with fewer than T shared values has no pair of T matches;
   of the rest only the prefix of the m - T + 1 rarest shared values is kept, since two
   classes with T matches must meet in it (prefix and skip).
3. A class is at home under the most frequent value of its prefix and visits the homes of all
   classes that it meets under a prefix value.  Homes are split into blocks, visitors into slices, of bounded rows and
   shingles, so a group of any size is dealt over many tasks, and no pair is ever
   a row: a task counts coordinate collisions of its block in numpy, keeps pairs of T matches
   or more, confirms them on the full sets, and emits a spanning forest of confirmed links.
   In a home of more than a block, some pivots are held against all first; what they join to one
   component is not compared within itself, so a large group of near copies costs about one row
   for each member instead of a number that grows with the group.
4. Star steps over these links give the components.

With K = 64 and T = 30 a pair of similarity 0.75 is missed with a chance below one in a million
(the binomial tail); confirmed links are exact up to 64-bit hash collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..operators.components import components
from ..tables import settle
from . import rows as of_row
from .hashing import as_unsigned, list_array, minima, mix, shingle_sets

WORDS, COORDINATES, MATCHES = 5, 64, 30
BLOCK_ROWS, BLOCK_SHINGLES, SLICE_ROWS, SLICE_SHINGLES = 512, 1 << 18, 2048, 1 << 22
#: About so many classes of a large home are held against all others first.
PIVOTS = 32


def sketches(docs: DataFrame, size: int = COORDINATES) -> DataFrame:
    """(doc_id, mark, n_shingles, s1, s2, sig): a hash of the text, set size, two sums that identify the set, and its MinHash coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for a, b, offs, hashes in shingle_sets(batch.column(2), WORDS):
                n = np.diff(offs)
                some = n > 0
                sums = np.zeros((2, b - a), np.uint64)
                with np.errstate(over="ignore"):
                    for k, x in enumerate((mix(hashes), mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))):
                        if len(x):
                            sums[k, some] = np.add.reduceat(x, offs[:-1][some])
                sig = minima(offs, hashes, size)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), marks.slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), list_array(np.concatenate([[0], np.cumsum(some * size)]), sig.reshape(-1))],
                    names=["doc_id", "mark", "n_shingles", "s1", "s2", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long"), of_row.mark().alias("mark"), F.col("text")).mapInArrow(run, "doc_id long, mark long, n_shingles long, s1 long, s2 long, sig array<long>")


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(rep, n_shingles, home, keys) of the classes that share at least ``matches`` coordinate values with others."""
    posts = classes.select("rep", F.explode("sig").alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rare_first = posts.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("p")).where(F.size("p") >= matches)
    short = rare_first.select("rep", F.expr(f"transform(slice(p, 1, size(p) - {matches - 1}), x -> x.key)").alias("keys"))
    return short.join(classes.select("rep", "n_shingles"), "rep").select("rep", "n_shingles", F.element_at("keys", -1).alias("home"), "keys")


def _visits(prefix: DataFrame) -> DataFrame:
    """(rep, home, n_shingles, dwells): the homes where each class is compared, and whether it is its own."""
    at = prefix.select("rep", "home", "n_shingles", F.explode("keys").alias("key"))
    homes = at.groupBy("key").agg(F.collect_set("home").alias("homes"))
    visits = at.join(homes, "key").groupBy("rep", "home", "n_shingles").agg(F.array_distinct(F.flatten(F.collect_list("homes"))).alias("homes"))
    return visits.select("rep", F.col("home").alias("own"), "n_shingles", F.explode(F.expr("filter(homes, h -> h <= home)")).alias("home")).select("rep", "home", "n_shingles", (F.col("own") == F.col("home")).alias("dwells"))


def _dealt(inner: DataFrame, visits: DataFrame, sizes: DataFrame) -> DataFrame:
    """(rep, home, block, slice, role): all of ``visits`` held against all of ``inner`` (both rep, home); role bit 1: belongs to the block, bit 2: is held against it.

    sizes: home, n and s (classes of inner and their shingles), v and vs (visits and their shingles).
    """
    sizes = sizes.select("home", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"), F.greatest(F.ceil(F.col("v") / SLICE_ROWS), F.ceil(F.col("vs") / SLICE_SHINGLES)).cast("int").alias("slices"))
    spot = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = inner.select("rep", "home").join(sizes, "home").select("rep", "home", spot("blocks", 1).alias("block"), every("slices").alias("slice"), F.lit(1).alias("role"))
    held = visits.select("rep", "home").join(sizes, "home").select("rep", "home", every("blocks").alias("block"), spot("slices", 2).alias("slice"), F.lit(2).alias("role"))
    return own.union(held).groupBy("rep", "home", "block", "slice").agg(F.bit_or("role").alias("role"))


def _unsettled(visits: DataFrame, sizes: DataFrame, reached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The (inner, sizes) that are still to be compared in large homes, where ``reached`` (rep, component) are the links that pivots gave.

    Classes of a home's largest component need no comparison with each other, so only those outside it make up the blocks;
    where these are more than the home's own classes, the latter do, as in small homes.
    """
    found = visits.join(sizes.select("home"), "home").join(reached, "rep", "left").select("rep", "home", "n_shingles", "dwells", F.coalesce("component", "rep").alias("component"))
    parts = found.groupBy("home", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    most = parts.groupBy("home").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.sum("n").alias("all"), F.max("n").alias("in_most"), F.sum("s").alias("s_all"), F.max_by("s", F.struct("n", "component")).alias("s_most"))
    rest = F.col("all") - F.col("in_most")
    plan = sizes.join(most, "home").where(rest > 0).withColumn("outside", rest <= F.col("n"))
    inner = found.join(plan.select("home", "most", "outside"), "home").where(F.when(F.col("outside"), F.col("component") != F.col("most")).otherwise(F.col("dwells")))
    left = plan.select("home", F.when(F.col("outside"), rest).otherwise(F.col("n")).alias("n"), F.when(F.col("outside"), F.col("s_all") - F.col("s_most")).otherwise(F.col("s")).alias("s"), "v", "vs")
    return inner.select("rep", "home"), left


def _links_of_block(ids: np.ndarray, role: np.ndarray, sig: np.ndarray, offs: np.ndarray, sets: np.ndarray, matches: int, percent: int) -> list[tuple[int, int]]:
    inside = np.flatnonzero(role & 1)
    held = np.flatnonzero(role & 2)
    if not len(inside) or len(held) == 0 or len(ids) < 2:
        return []
    n = np.diff(offs)
    mine = np.concatenate([sets[offs[i] : offs[i + 1]] for i in inside])
    owner = np.repeat(np.arange(len(inside)), n[inside])
    order = np.argsort(mine, kind="stable")
    mine, owner = mine[order], owner[order]
    sig_in, id_in, n_in = sig[inside], ids[inside], n[inside]
    label = np.arange(len(inside))
    place = {int(i): k for k, i in enumerate(inside)}
    out = []
    for p in held.tolist():
        maybe = ((sig_in == sig[p]).sum(axis=1) >= matches) & (id_in != ids[p])
        if not maybe.any():
            continue
        own = sets[offs[p] : offs[p + 1]]
        lo, hi = np.searchsorted(mine, own, "left"), np.searchsorted(mine, own, "right")
        c = hi - lo
        at = np.repeat(lo - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
        common = np.bincount(owner[at], minlength=len(inside))
        linked = np.flatnonzero(maybe & (100 * common >= percent * (n[p] + n_in - common)))
        if not len(linked):
            continue
        labels, first = np.unique(label[linked], return_index=True)
        if p in place:  # p is of this block: what it is joined to already needs no further link
            mine_now = label[place[p]]
            first = first[labels != mine_now]
            labels = np.append(labels, mine_now)
        out += [(int(ids[p]), int(id_in[linked[f]])) for f in first]
        label[np.isin(label, labels)] = labels.min()
    return out


def _links(rows: DataFrame, matches: int, percent: int) -> DataFrame:
    """rows: (home, block, slice, role, rep, sig, text), one row for each class and place.  Returns confirmed links (a, b)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, offs, hashes in shingle_sets(batch.column("text"), WORDS):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("home", "block", "slice", "role", "rep", "sig")), list_array(offs, hashes)], names=["home", "block", "slice", "role", "rep", "sig", "shingles"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> list[tuple[int, int]]:
            _, sig = as_unsigned(t.column("sig"))
            offs, values = as_unsigned(t.column("shingles"))
            return _links_of_block(t.column("rep").to_numpy(), t.column("role").to_numpy(), sig.reshape(t.num_rows, -1), offs, values, matches, percent)

        def edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            x = np.array(pairs, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

        rest: pa.Table | None = None  # rows of the last block, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("home", "block", "slice")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            pairs, at = [], 0
            for end in cuts.tolist():
                pairs += found(t.slice(at, end - at))
                at = end
            rest = t.slice(at)
            if pairs:
                yield edges(pairs)
        if rest is not None and (pairs := found(rest)):
            yield edges(pairs)

    held = rows.select("home", "block", "slice", "role", "rep", "sig", "text").mapInArrow(sets, "home long, block int, slice int, role int, rep long, sig array<long>, shingles array<long>")
    return held.repartition("home", "block", "slice").sortWithinPartitions("home", "block", "slice").mapInArrow(match, "a long, b long").distinct()


def _judged(docs: DataFrame, percent: int, size: int, matches: int) -> DataFrame:
    """What :func:`near_duplicates` gives, and mark, a hash of the text."""
    docs = docs.select("doc_id", "text")
    sk = settle(sketches(docs, size), "sketches")
    key = ["s1", "s2", "n_shingles"]
    classes = sk.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = settle(classes, "classes")
    prefix = settle(_prefixes(classes, matches), "prefixes")
    visits = settle(_visits(prefix), "visits")
    sizes = visits.groupBy("home").agg(F.count_if("dwells").alias("n"), F.sum(F.when(F.col("dwells"), F.col("n_shingles")).otherwise(0)).alias("s"), F.count("*").alias("v"), F.sum("n_shingles").alias("vs"))
    sizes = settle(sizes.where("v > 1"), "homes")
    texts = docs.where("doc_id is not null").withColumnRenamed("doc_id", "rep")
    if not sk.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():  # else each repetition of a row would be compared
        alike = ["rep", of_row.mark()]
        texts = texts.withColumn("rank", F.row_number().over(W.partitionBy(*alike).orderBy("rep"))).where("rank = 1").drop("rank")

    def linked(dealt: DataFrame) -> DataFrame:
        return _links(dealt.join(classes.select("rep", "sig"), "rep").join(texts, "rep"), matches, percent)

    many = (F.col("n") > BLOCK_ROWS) | (F.col("s") > BLOCK_SHINGLES)  # in one block each visit is one row, with or without pivots
    small, large = sizes.where(~many), sizes.where(many)
    inner, left, links = visits.where("dwells"), small, None
    if not large.isEmpty():
        chosen = F.pmod(F.xxhash64("rep", F.lit(3)), F.ceil(F.col("v") / PIVOTS)) == 0
        pivots = settle(visits.join(large.select("home", "v"), "home").where(chosen).select("rep", "home", "n_shingles"), "pivots")
        about = pivots.groupBy("home").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).join(large.select("home", "v", "vs"), "home")
        links = settle(linked(_dealt(pivots, visits, about)), "pivot-links")
        more, of_large = _unsettled(visits, large, components(links).withColumnRenamed("node", "rep"))
        inner, left = inner.join(small.select("home"), "home", "left_semi").select("rep", "home").union(more), small.union(of_large.select(*small.columns))
    found = linked(_dealt(inner, visits, left))
    reached = components(found if links is None else found.union(links)).withColumnRenamed("node", "rep")
    of_class = classes.select(*key, "rep").join(reached, "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = sk.select("doc_id", "mark", *key).join(of_class, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "mark", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text; other columns are ignored).

    Two documents are linked if ``100 * |intersection| >= percent * |union|`` of their shingle sets; component_id is the
    least doc_id that links reach.  A null, empty or wordless text has no shingles and is linked with nothing.  Rows that
    repeat a doc_id count as one document; a row whose doc_id is null gets the component of its text (null where no
    other text is linked) and is never kept.  An empty table gives an empty result.  Texts are used whole.
    """
    return _judged(docs, percent, size, matches).drop("mark")


def deduplicated(docs: DataFrame, percent: int = 75, size: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """``docs`` with one document of each group of near copies, that with the least doc_id; all columns stay.

    A row without a doc_id is a document known by its text and comes after all that have one: it goes if another document
    is its near copy, else it stays.  Of rows that repeat a doc_id and text one stays, whichever; the others are left out in
    the tasks that read them, so that a row repeated very often is not gathered in one.  A document without words has no copies.
    """
    same = ["key", "mark"]
    kept = _judged(docs.select(of_row.key().alias("doc_id"), "text"), percent, size, matches).where("kept").select(F.col("doc_id").alias("key"), "mark").distinct()
    once = of_row.keyed(docs).withColumn("rank", F.row_number().over(W.partitionBy(*same).orderBy("mark"))).where("rank = 1")
    return once.join(kept, same, "left_semi").select("row.*")

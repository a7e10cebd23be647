"""Benchmark decontamination: MinHash containment search for short items inside long documents.

Jaccard similarity between an item of 30 shingles and a document of 20,000 is near zero, so signatures of
both sides can't be compared.  The chance that the least shingle of an *item* under a hash function lies in
a document is exactly the item's containment in it, whatever the document's size; so only items get
signatures.  Items are partitioned by size, in classes of floor(log2(shingles)), and each class has its own
number of coordinates and of matches that makes an item a candidate: items of fewer than 16 shingles are posted
whole, so that the count is already exact; of the others each class has eight coordinates more than the one
before, since a false candidate costs more the larger the item is, and as many matches as an item at the bound
misses with a chance of one in a million at most.  Candidates are confirmed by exact containment of the item's
shingle set.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..tables import settle
from .hashing import list_array, shingle_sets, stream
from .rows import key, keyed

WORDS, SMALL_CLASSES, STEP, MISSED = 5, 4, 8, 1e-6
CLASSES = 32
#: The filter of item shingles that tasks get: bits for each shingle, and its least and greatest size (16 MB), as powers of two.
FILTER_BITS, LEAST_LOG, MOST_LOG = 32, 16, 27


def coordinates(size_class: int) -> int:
    """Coordinates of the items of a class; 0 where they are posted whole."""
    return 0 if size_class < SMALL_CLASSES else STEP * (size_class + 1)


def matches(size_class: int, percent: int) -> int:
    """The most matches that an item of the class with ``percent`` of its shingles in a document falls short of with a chance of MISSED at most."""
    k, p, tail = coordinates(size_class), percent / 100, 0.0
    for t in range(k):
        tail += comb(k, t) * p**t * (1 - p) ** (k - t)
        if tail > MISSED:
            return max(1, t)
    return max(1, k)


def item_sets(items: DataFrame) -> DataFrame:
    """(item_id, n_shingles, shingles, size_class, sample) of the items that have words.

    size_class is floor(log2(n_shingles)); sample holds one shingle for each coordinate of the class, the least under its hash function.
    """
    most = coordinates(CLASSES)
    factors, shifts = stream(31, most) | np.uint64(1), stream(32, most)
    inverse = np.array([pow(int(f), -1, 1 << 64) for f in factors], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, offs, hashes in shingle_sets(batch.column(1), WORDS):
                samples, ends = [], [0]
                with np.errstate(over="ignore"):
                    for r in range(b - a):
                        own = hashes[offs[r] : offs[r + 1]]
                        if k := coordinates(len(own).bit_length() - 1):
                            own = (np.array([((own ^ s) * f).min() for f, s in zip(factors[:k], shifts[:k])], np.uint64) * inverse[:k]) ^ shifts[:k]
                        samples.append(own)
                        ends.append(ends[-1] + len(own))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), list_array(offs, hashes), list_array(np.array(ends), np.concatenate([*samples, np.zeros(0, np.uint64)]))], names=["item_id", "shingles", "sample"])

    sets = items.select(F.col("item_id").cast("long"), F.col("text")).mapInArrow(run, "item_id long, shingles array<long>, sample array<long>")
    n = F.size("shingles")
    return sets.where((n > 0) & F.col("item_id").isNotNull()).select("item_id", n.alias("n_shingles"), "shingles", (F.length(F.bin(n)) - 1).alias("size_class"), "sample")


def _filter(items: DataFrame) -> tuple[int, np.ndarray]:
    """A bitmap of the items' shingles by their leading bits; at most 2 ** MOST_LOG bits, whatever the number of items."""
    n = items.agg(F.sum("n_shingles")).first()[0] or 0
    log = min(MOST_LOG, max(LEAST_LOG, (FILTER_BITS * n).bit_length()))
    bits = items.select(F.explode("shingles").alias("s")).select(F.shiftrightunsigned("s", 64 - log).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(1 << (log - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return log, out.view(np.uint64)


def _hits(docs: DataFrame, log: int, bitmap: np.ndarray) -> DataFrame:
    """(doc_id, hits): the shingles of a document that pass the bitmap; documents without any are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for a, b, offs, hashes in shingle_sets(batch.column(1), WORDS):
                at = hashes >> np.uint64(64 - log)
                hit = ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
                if not hit.any():
                    continue
                ends = np.concatenate([[0], np.cumsum(hit)])[offs]
                some = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(some)), list_array(np.concatenate([ends[some], ends[-1:]]), hashes[hit])], names=["doc_id", "hits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).where("doc_id is not null").mapInArrow(run, "doc_id long, hits array<long>")


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment) for each item with at least ``percent`` of its distinct 5-word shingles in a document.

    docs: doc_id, text; items: item_id, text; other columns are ignored.  Null, empty and wordless texts match nothing, nor do
    rows without an id.  An item of fewer than five words is one shingle, its whole sequence, and is found only in a text that
    is that sequence.  Rows that repeat an id give one row, of the largest overlap.  Empty tables give an empty result.
    """
    sets = settle(item_sets(items), "items")
    log, bitmap = _filter(sets)
    hits = settle(_hits(docs, log, bitmap), "hits")
    of_class = F.create_map(*[F.lit(x) for c in range(SMALL_CLASSES, CLASSES) for x in (c, matches(c, percent))])
    least = F.coalesce(F.element_at(of_class, F.col("size_class")), F.ceil(F.col("n_shingles") * percent / 100))
    posts = sets.select("item_id", "size_class", least.cast("int").alias("least"), F.posexplode("sample").alias("coordinate", "shingle"))
    found = hits.select("doc_id", F.explode("hits").alias("shingle")).join(posts, "shingle")
    maybe = found.groupBy("size_class", "item_id", "doc_id", "least").agg(F.countDistinct("coordinate").alias("n")).where("n >= least").select("doc_id", "item_id")
    both = maybe.join(sets.select("item_id", "n_shingles", "shingles"), "item_id").join(hits, "doc_id")
    shared = both.select("doc_id", "item_id", "n_shingles", F.size(F.array_intersect("hits", "shingles")).alias("shared"))
    kept = shared.where(F.col("shared") * 100 >= F.col("n_shingles") * percent).groupBy("doc_id", "item_id").agg(F.max("n_shingles").cast("long").alias("item_shingles"), F.max("shared").cast("long").alias("shared"))
    return kept.withColumn("containment", F.round(F.col("shared") / F.col("item_shingles"), 6))


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay.  Rows without a doc_id are judged by their texts, rows that repeat one go together."""
    bad = contained_items(docs.select(key().alias("doc_id"), "text"), items, percent).select(F.col("doc_id").alias("key")).distinct()
    return keyed(docs).join(bad, "key", "left_anti").select("row.*")

"""Language identification by interpolated Kneser-Ney character models.

Counts of character 4-grams of all texts are summed on Spark.  Lower orders use continuation counts (how many different
characters stand before a gram), so the 4-gram table of the labelled texts is all that the models need: discounted shares of
grams and left-over weights of contexts are tables of each order, and the log probabilities of every gram that any text holds
come from them by joins, order by order.  For prediction the most common grams are a sorted array of 64-bit hashes beside a
column of log probabilities for each language, with a radix index in front of the binary search; its size is bounded.  What a
text holds beside these is joined with the table of the other grams, so that texts are read once for scoring whatever the
number of grams, and no gram of that join is a common one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..tables import settle
from . import rows as of_row
from .hashing import PIECE, groups_of_rows, list_array, mix, text_buffers

ORDER = 4
#: The array of common grams that tasks get has at most so many values (4 bytes each, a gram has one for each language and two for its hash).
HEAD_VALUES = 8_000_000
#: A task sends on its counts when it holds so many grams.
HELD_GRAMS = 4_000_000
#: Share of calibration documents of a language that may score worse than its rejection threshold before the margin is added.
REJECTED_SHARE, REJECTION_MARGIN = 0.001, 1.5
TEMPERATURES = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
_SPACE = 32
_U = np.uint64
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Code point to symbol: letters of all planes to their lower case, all else to a space.

    A symbol has 16 bits, so letters beyond U+FFFF come to one symbol for each 128 code points, of those for private use,
    which are no letters: scripts and parts of them stay apart.
    """
    if not _FOLD:
        table = np.full(0x110000, _SPACE, np.uint16)
        for i in range(65, 0x110000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                point = ord(low) if len(low) == 1 else i
                table[i] = point if point < 0x10000 else 0xE000 + ((point - 0x10000) >> 7) % 6400
        _FOLD.append(table)
    return _FOLD[0]


def _symbols(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the rows between offs, with one space for each run of others and a space at the start of each row; and their rows."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offs]
    symbol = _fold_table()[points]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(starts))
    filled = np.flatnonzero(np.diff(starts))
    symbol = np.insert(symbol, starts[filled], _SPACE)
    row = np.insert(row, starts[filled], filled)
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != _SPACE) | (symbol[:-1] != _SPACE) | (row[1:] != row[:-1])
    return symbol[keep], row[keep]


def _grams(symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each symbol, 16 bits a symbol; before a row's start there are spaces."""
    key = symbol.astype(_U)
    for k in range(1, ORDER):
        before = np.full(len(symbol), _SPACE, _U)
        if len(symbol) > k:
            same = row[k:] == row[:-k]
            before[k:][same] = symbol[:-k][same]
        key |= before << _U(16 * k)
    return key


def _runs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, 4-gram, last symbol) of all symbols of a column's texts, about a megabyte of text at a time; a longer text comes in pieces."""
    raw, offs = text_buffers(column)
    for a, b in groups_of_rows(offs):
        if offs[b] - offs[a] <= PIECE:
            symbol, row = _symbols(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            yield row + a, _grams(symbol, row), symbol
            continue
        before, at = np.full(ORDER - 1, _SPACE, np.uint16), int(offs[a])
        while at < offs[b]:
            end = min(int(offs[b]), at + PIECE)
            while end < offs[b] and raw[end] & 0xC0 == 0x80:
                end += 1
            symbol, _ = _symbols(raw[at:end], np.array([0, end - at]))
            if at > offs[a]:  # of the space at the start only what the text itself has there stays
                first = ord(raw[at : at + 4].tobytes().decode("utf-8", "replace")[0])
                symbol = symbol[int(before[-1] == _SPACE or _fold_table()[first] != _SPACE) :]
            whole = np.concatenate([before, symbol])
            yield np.full(len(symbol), a), _grams(whole, np.zeros(len(whole), np.int64))[ORDER - 1 :], symbol
            before, at = whole[-(ORDER - 1) :], end


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) of texts (text, lang), a null lang being one of its own: each task adds up its own counts first."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def sent(held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for name, parts in held.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            names = [*coded.dictionary.to_pylist(), None]
            which = coded.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
            for row, key, _ in _runs(batch.column(0)):
                for k in np.unique(which[row]):
                    held.setdefault(names[k], []).append(np.unique(key[which[row] == k], return_counts=True))
                    if len(held[names[k]]) >= 16:
                        held[names[k]] = [merged(held[names[k]])]
                if sum(len(keys) for parts in held.values() for keys, _ in parts) > HELD_GRAMS:
                    yield from sent(held)
                    held = {}
        yield from sent(held)

    counts = texts.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class HashTable:
    """A sorted array of gram hashes beside rows of values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = np.append(hashes[order], _U(0xFFFFFFFFFFFFFFFF)), np.append(values[order].astype(np.float32), np.zeros((1, values.shape[1]), np.float32), axis=0)
        self.shift = _U(64 - max(4, len(keys).bit_length()))
        self.first = np.searchsorted(self.hashes[:-1], np.arange(1 << int(64 - int(self.shift)), dtype=_U) << self.shift).astype(np.int64)
        ends = np.append(self.first[1:], len(keys))
        self.deepest = int((ends - self.first).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys, and which are there."""
        h = mix(keys)
        at = self.first[h >> self.shift]
        for _ in range(self.deepest):
            at += self.hashes[at] < h
        return at, self.hashes[at] == h


@dataclass
class Models:
    """By order 1 to 4: seen (lang, key, share), the discounted share of a gram in its context, and left (lang, head, weight), what a context leaves to the next lower order."""

    langs: list[str]
    seen: dict[int, DataFrame]
    left: dict[int, DataFrame]
    floor: dict[str, float]


def _discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _of_lang(values: dict[str, float]) -> F.Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("lang"))


def _last(order: int) -> F.Column:
    """The last symbols of a gram."""
    return F.col("gram") if order == ORDER else F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))


def fit(counts: DataFrame) -> Models:
    """Interpolated Kneser-Ney models of each language from its 4-gram counts (lang, gram, n); the driver sees some numbers for each language and order."""
    now, seen, left, sizes = counts, {}, {}, {}
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            now = settle(now.groupBy("lang", _last(order).alias("gram")).agg(F.count("*").alias("n")), "grams")
        found = now.groupBy("lang").agg(F.count("*").alias("size"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()
        sizes = {r["lang"]: r["size"] for r in found}
        discount = _of_lang({r["lang"]: _discount(r["ones"], r["twos"]) for r in found}) if found else F.lit(0.5)
        grams = now.select("lang", F.col("gram").alias("key"), F.shiftrightunsigned("gram", 16).alias("head"), "n")
        heads = settle(grams.groupBy("lang", "head").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), "heads")
        whole = F.broadcast(heads) if order == 1 else heads  # a row for each language
        seen[order] = settle(grams.join(whole, ["lang", "head"]).select("lang", "key", ((F.col("n") - discount) / F.col("total")).alias("share")), "seen")
        left[order] = heads.select("lang", "head", (discount * F.col("kinds") / F.col("total")).alias("weight"))
    return Models(sorted(sizes), seen, left, {lang: 1.0 / (n + 1) for lang, n in sizes.items()})


def log_probabilities(grams: DataFrame, models: Models) -> DataFrame:
    """grams (gram and other columns, each gram once) with v, the log probability of the last symbol after the others by each language.

    Tables of single symbols (at most 65,536 for each language) are broadcast, the others are joined by gram and language.
    """
    now = grams.select("gram", F.explode(F.array(*[F.lit(x) for x in models.langs])).alias("lang")).withColumn("p", _of_lang(models.floor))
    for order in range(1, ORDER + 1):
        seen = F.broadcast(models.seen[order]) if order == 1 else models.seen[order]
        left = F.broadcast(models.left[order]) if order <= 2 else models.left[order]
        now = now.withColumn("key", _last(order)).withColumn("head", F.shiftrightunsigned("key", 16))
        now = now.join(seen, ["lang", "key"], "left").join(left, ["lang", "head"], "left")
        now = now.select("gram", "lang", (F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("p")).alias("p"))
    each = now.groupBy("gram").agg(*[F.max(F.when(F.col("lang") == x, F.log("p"))).alias(f"p{k}") for k, x in enumerate(models.langs)])
    return grams.join(each.select("gram", F.array(*[f"p{k}" for k in range(len(models.langs))]).alias("v")), "gram")


def _head(table: DataFrame, langs: int, most: int) -> tuple[DataFrame, HashTable]:
    """The table (gram, n, v) without its most common grams, and these: by classes of counts (powers of two), as many as ``most`` values hold."""
    size = F.length(F.bin("n"))
    room, least = most // (langs + 2), 65
    for r in table.groupBy(size.alias("c")).agg(F.count("*").alias("k")).orderBy(F.desc("c")).collect():
        if (room := room - r.k) < 0:
            break
        least = r.c
    found = table.where(size >= least).select("gram", "v").toArrow()
    values = found.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False) if found.num_rows else np.zeros(0)
    return table.where(size < least), HashTable(found.column("gram").to_numpy().view(_U), values.reshape(-1, langs))


def _entropies(docs: DataFrame, head: HashTable, langs: int) -> DataFrame:
    """docs (text and other columns) with n, the number of symbols (0 without a letter), sums, their log probabilities by each language, and rest and times, the grams not in ``head``, which sums leave out, and how often they occur."""
    others = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            size = batch.num_rows
            count, letters, sums = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros((size, langs))
            rest = [(np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64))]
            for row, key, symbol in _runs(batch.column("text")):
                if not len(row):
                    continue
                a, b = int(row[0]), int(row[-1]) + 1
                count[a:b] += np.bincount(row - a, minlength=b - a)
                letters[a:b] += np.bincount(row[symbol != _SPACE] - a, minlength=b - a)
                place, there = table.find(key)
                value = np.where(there[:, None], table.values[place], np.float32(0))
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                sums[row[starts]] += np.add.reduceat(value, starts, axis=0, dtype=np.float64)
                if not there.all():
                    own, gram = row[~there], key[~there]
                    order = np.lexsort((gram, own))
                    own, gram = own[order], gram[order]
                    fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (gram[1:] != gram[:-1])]))
                    rest.append((own[fresh], gram[fresh], np.diff(np.append(fresh, len(own)))))
            own, gram, times = (np.concatenate(x) for x in zip(*rest))
            ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=size))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(np.where(letters > 0, count, 0)), pa.ListArray.from_arrays(pa.array(np.arange(0, (size + 1) * langs, langs, dtype=np.int32)), pa.array(sums.reshape(-1))), list_array(ends, gram), list_array(ends, times)],
                names=[*others, "n", "sums", "rest", "times"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, schema + ", n long, sums array<double>, rest array<long>, times array<long>")


def _scored(rows: DataFrame, counts: DataFrame, head_values: int) -> tuple[list[str], DataFrame]:
    """The languages, and rows without texts, with n and e, the cross-entropy per symbol under each language; counts: those of all rows' grams, by language where it may be learned."""
    models = fit(counts.where("lang is not null"))
    langs = len(models.langs)
    grams = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    tail, head = _head(settle(log_probabilities(grams, models), "probabilities"), langs, head_values)
    part = settle(_entropies(rows.withColumn("row", F.monotonically_increasing_id()), head, langs), "sums")
    e = lambda more: F.array(*[-(F.col("sums")[k] + more(k)) / F.greatest(F.lit(1), "n") for k in range(langs)]).alias("e")
    others = [c for c in rows.columns if c != "text"] + ["n"]
    some = F.size("rest") > 0
    lost = part.where(some).select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("gram"), "x.times")
    more = lost.join(tail.select("gram", "v"), "gram").groupBy("row").agg(F.array(*[F.sum(F.col("times") * F.col("v")[k]) for k in range(langs)]).alias("more"))
    whole = part.where(~some).select(*others, e(lambda k: F.lit(0.0)))
    return models.langs, settle(whole.union(part.where(some).join(more, "row").select(*others, e(lambda k: F.col("more")[k]))), "entropies")


def _judged(docs: DataFrame, head_values: int) -> DataFrame:
    """What :func:`identify` gives, and mark, a hash of the text."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    rows = docs.select("doc_id", of_row.mark().alias("mark"), "text", "lang", F.coalesce(fold, F.lit(2)).cast("int").alias("fold"))
    counts = settle(gram_counts(rows.select("text", F.when(F.col("fold") < 2, F.col("lang")).alias("lang"))), "grams")
    if counts.where("lang is not null").isEmpty():
        return rows.select("doc_id", "mark", (F.col("fold") == 2).alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("entropy"))
    names, scored = _scored(rows, counts, head_values)
    langs = F.array(*[F.lit(x) for x in names])
    least = F.array_min("e")
    confidence = lambda t: F.lit(1.0) / F.aggregate("e", F.lit(0.0), lambda s, x: s + F.exp((F.array_min("e") - x) * t))
    known = scored.where("fold = 3 and n > 0 and lang is not null").withColumn("right", F.array_position(langs, F.col("lang"))).where("right > 0")
    loss = known.agg(*[F.avg(F.log(F.greatest(F.lit(1e-9), confidence(t) * F.exp((least - F.expr("e[int(right) - 1]")) * t)))).alias(str(k)) for k, t in enumerate(TEMPERATURES)]).first()
    heat = max(range(len(TEMPERATURES)), key=lambda k: (loss[k] is not None and loss[k], -k))
    pred = F.element_at(langs, F.array_position("e", least).cast("int"))
    said = scored.select("doc_id", "mark", "fold", "n", "lang", pred.alias("pred"), least.alias("entropy"), confidence(TEMPERATURES[heat]).alias("score"))
    right = said.where("fold = 3 and n > 0 and lang = pred")
    middle = right.groupBy("pred").agg(F.avg("entropy").alias("mean"))
    strain = lambda mean: (F.col("entropy") - mean) * F.sqrt(F.least(F.col("n"), F.lit(400)))
    limits = right.join(F.broadcast(middle), "pred").groupBy("pred").agg(F.first("mean").alias("mean"), (F.percentile_approx(strain(F.col("mean")), 1 - REJECTED_SHARE, 10000) * REJECTION_MARGIN).alias("most"))
    out = said.join(F.broadcast(limits), "pred", "left")  # a row for each language
    letters = F.col("n") > 0
    return out.select(
        "doc_id", "mark", (F.col("fold") == 2).alias("held_out"), F.when(letters, F.col("pred")).otherwise("und").alias("lang_pred"), F.when(letters, F.col("score")).otherwise(0.0).alias("score"),
        (~letters | F.coalesce(strain(F.col("mean")) > F.col("most"), F.lit(False))).alias("rejected"), F.when(letters, F.col("entropy")).alias("entropy"),
    )


def identify(docs: DataFrame, head_values: int = HEAD_VALUES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected, entropy) for each row of ``docs`` (doc_id, text, lang).

    Models learn from the rows with a lang whose crc32(doc_id as text) mod 4 is 0 or 1; those of remainder 3 calibrate
    confidence and rejection; remainder 2 (and rows without a doc_id) are held out.  lang, source and doc_id are never
    inputs of a prediction.  lang_pred is the language of the lowest cross-entropy per symbol (ties: first by name), ``und``
    for a null text or one without a letter, or if nothing could be learned; score is its calibrated probability (``und``: 0).
    rejected: ``und``, or worse than the language's own calibration documents by a wide margin, given the text's length.
    Whole texts are used, of any length.  Rows that repeat are predicted alike.  An empty table gives an empty result.
    """
    return _judged(docs, head_values).drop("mark")


def spoken(docs: DataFrame, head_values: int = HEAD_VALUES) -> DataFrame:
    """``docs`` without the rows that :func:`identify` rejects; all columns stay, and so do accepted rows without a doc_id and repeated ones."""
    bad = _judged(docs, head_values).where("rejected").select("doc_id", F.col("mark").alias("bad")).distinct()
    return of_row.keyed(docs).join(bad, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("bad")), "left_anti").select("row.*")

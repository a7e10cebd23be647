"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated isotonically."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..tables import settle
from .hashing import groups_of_rows, mix, text_buffers, word_hashes

FEATURES, WIDTH, RIDGE, SEED, BINS = 128, 3.0, 1e-3, 17, 1024
STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "mark", "symbol", "beyond_ascii", "line_ends", "repeats", "distinct_words", "distinct_pairs", "top_word", "bars")

#: Byte classes: 0 lower case, 1 upper case, 2 digit, 3 gap, 4 line end, 5 sentence mark, 6 symbol, 7 beyond ASCII, 8 bar or angle.
_CLASS = np.full(256, 6, np.int64)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9, 11, 12), (10, 13), b".,;:'\"?-()", (), range(128, 256), b"|<>")):
    _CLASS[list(_bytes)] = _k


def _statistics(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows x STATISTICS."""
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(offs))
    c = np.bincount(row * 9 + _CLASS[raw], minlength=n * 9).reshape(n, 9).astype(float)
    size = np.maximum(np.diff(offs), 1)
    wrow, word = word_hashes(raw, offs)
    words = np.bincount(wrow, minlength=n)
    some = np.maximum(words, 1)
    out = np.zeros((n, len(STATISTICS)))
    out[:, 0], out[:, 1] = np.log1p(np.diff(offs)), np.log1p(words)
    out[:, 2] = np.log1p((size - c[:, 3] - c[:, 4]) / some)
    letters = np.maximum(c[:, 0] + c[:, 1] + c[:, 7], 1)
    out[:, 3] = c[:, 1] / letters
    for at, k in ((4, 2), (5, 5), (6, 6), (7, 7), (8, 4), (13, 8)):
        out[:, at] = np.sqrt(c[:, k] / size)
    if len(word):
        same = wrow[1:] == wrow[:-1]
        out[:, 9] = np.bincount(wrow[1:], weights=(word[1:] == word[:-1]) & same, minlength=n) / some
        with np.errstate(over="ignore"):
            pair = mix(word[1:] * np.uint64(3) + word[:-1])[same]
        for at, key, own in ((10, word, wrow), (11, pair, wrow[1:][same])):
            order = np.lexsort((key, own))
            key, own = key[order], own[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
            n_own = np.bincount(own, minlength=n)
            out[:, at] = np.log1p(np.bincount(own, weights=fresh, minlength=n)) - np.log1p(n_own)
            if at == 10:
                starts = np.flatnonzero(fresh)
                np.maximum.at(out[:, 12], own[starts], np.diff(np.append(starts, len(key))))
        out[:, 12] /= some
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """docs (text and other columns) with x, the STATISTICS of the whole text in place of it; a null text counts as empty."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffers(batch.column("text"))
            for a, b in groups_of_rows(offs):
                x = _statistics(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                k = x.shape[1]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in others), pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * k, k, dtype=np.int32)), pa.array(x.reshape(-1)))], names=[*others, "x"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, schema + ", x array<double>")


class Lift:
    """Standardised statistics to FEATURES cosines whose inner products approach a Gaussian kernel, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w, self.b = random.normal(0, 1 / WIDTH, (len(mean), FEATURES)), random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.spread, -8, 8) @ self.w + self.b) * np.sqrt(2 / FEATURES)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_equations(rows: DataFrame, lift: Lift) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of rows (x, y): each partition adds up its own, Spark adds up the partitions entry by entry."""
    d = FEATURES + 1
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                z, y = lift(_matrix(part.column(0))), part.column(1).to_numpy()
                a += z.T @ z
                b += z.T @ y
        values = np.concatenate([a[upper], b])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["k", "v"])

    total = rows.select("x", "y").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    values = np.zeros(len(upper[0]) + d)
    values[total.column("k").to_numpy()] = total.column("v").to_numpy()
    a = np.zeros((d, d))
    a[upper] = values[: len(upper[0])]
    return a + np.triu(a, 1).T, values[len(upper[0]) :]


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``mean`` under ``weight`` (pool adjacent violators)."""
    pools: list[list[float]] = []
    for w, m in zip(weight.tolist(), mean.tolist()):
        pools.append([m, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, n2 = pools.pop()
            m1, w1, n1 = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text); labels: doc_id, quality 0 or 1.

    Labels count only where crc32(doc_id as text) mod 3 is not 1 (rows without a doc_id are held out); a quarter of these
    by hash calibrates, the others fit.  labels, lang, source and doc_id are never inputs of a score, only the text is.
    score is 0 to 1, higher where label 1 is likelier; predicted is 1 at 0.5 or more.  Null and empty texts are scored as
    texts without words; a document with several labels counts with their mean.  Without any label all scores are 0.5.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    rows = settle(statistics(docs.select("doc_id", F.coalesce(crc % 3, F.lit(1)).cast("int").alias("fold"), (crc % 12 > 8).alias("calibrates"), "text")), "statistics")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))
    known = settle(rows.where("fold <> 1").join(marks, "doc_id").select("x", "y", "calibrates"), "labelled")
    fitted = known.where("not calibrates")
    k = len(STATISTICS)
    moments = fitted.agg(F.count("*"), *[F.avg(F.col("x")[i]) for i in range(k)], *[F.stddev_pop(F.col("x")[i]) for i in range(k)]).first()
    held_out = (F.col("fold") == 1).alias("held_out")
    if not moments[0]:
        return rows.select("doc_id", held_out, F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    lift = Lift(np.array(moments[1 : k + 1], float), np.array(moments[k + 1 :], float))
    a, b = normal_equations(fitted, lift)
    weights = np.linalg.solve(a + RIDGE * moments[0] * np.eye(len(b)) / FEATURES, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.concatenate([np.zeros(0), *(lift(_matrix(batch.column("x").slice(k, 4096))) @ weights for k in range(0, batch.num_rows, 4096))])
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns) if n != "x"), pa.array(np.clip(raw, -0.5, 1.5))], names=[*(n for n in batch.schema.names if n != "x"), "raw"])

    at = (F.col("raw") + 0.5) / 2 * BINS
    bin_ = F.least(F.floor(at), F.lit(BINS - 1)).cast("int")
    judged = known.where("calibrates").select("y", "x").mapInArrow(run, "y double, raw double").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.avg("raw").alias("r"), F.avg("y").alias("m")).orderBy("bin").collect()
    edges = np.linspace(-0.5, 1.5, BINS + 1)
    if judged:
        fit = np.clip(isotonic(np.array([r["n"] for r in judged]), np.array([r["m"] for r in judged])), 0.001, 0.999)
        curve = np.interp(edges, [r["r"] for r in judged], fit)
    else:
        curve = np.clip(edges, 0, 1)
    curve = 0.98 * curve + 0.02 * np.linspace(0, 1, BINS + 1)  # strictly rising, so that ranks within a level stay
    table = docs.sparkSession.createDataFrame([(i, float(curve[i]), float(curve[i + 1])) for i in range(BINS)], "bin int, low double, high double")
    raw = rows.select("doc_id", "fold", "x").mapInArrow(run, "doc_id long, fold int, raw double").withColumns({"bin": bin_, "part": at - bin_})
    calibrated = F.round(F.col("low") + (F.col("high") - F.col("low")) * F.least(F.col("part"), F.lit(1.0)), 6)
    out = raw.join(F.broadcast(table), "bin").select("doc_id", held_out, calibrated.alias("score"))  # BINS rows
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Quality rules: word and line rules, and compression bands.

Text that repeats itself compresses too well and text that is not language compresses too badly.  The zstandard ratio
(compressed bytes per byte) of the whole document must lie in a band that depends on its length, since short texts give
the compressor little to find; and so must that of most of its fixed chunks, so that a long document can't hide a
repetitive or incompressible half in a good average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .hashing import SEPARATOR, groups_of_rows, mix, stream, text_buffers

LEVEL, CHUNK, WINDOW = 3, 4096, 8
#: (from bytes, least ratio, greatest ratio) of whole documents; a document shorter than the first has no band.
BANDS = ((64, 0.30, 1.25), (256, 0.25, 0.95), (1024, 0.22, 0.80), (4096, 0.20, 0.72), (16384, 0.18, 0.70), (65536, 0.15, 0.68))
#: Band of full chunks, and the percentage of a document's bytes in chunks outside it from which it is rejected.
CHUNK_BAND, CHUNK_SHARE = (0.20, 0.72), 40
#: The word rules' limits.
LEAST_WORDS, MOST_REPEATED = 20, 30
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

PIECE = 1 << 20
_U = np.uint64
_VALUE = stream(29, 256)
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = (np.cumprod(np.concatenate([[_U(1)], np.full(2 * PIECE, base, _U)]), dtype=_U) for base in (_BASE, pow(_BASE, -1, 1 << 64)))


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of spans, in pieces of at most two megabytes; a longer span is folded from parts."""
    out = np.empty(len(starts), _U)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            first = int(starts[at])
            stop = max(at + 1, int(np.searchsorted(ends, first + PIECE, "right")))
            if ends[stop - 1] - first > 2 * PIECE:  # one long span
                total, size = _U(0), int(ends[at]) - first
                for k in range(first, first + size, PIECE):
                    part = raw[k : min(k + PIECE, first + size)]
                    total = mix(np.array([total * _U(_BASE) + (_VALUE[part] * _UP[: len(part)]).sum(dtype=_U)], _U))[0]
                out[at] = mix(np.array([total + _U(size)], _U))[0]
                at += 1
                continue
            own = raw[first : int(ends[stop - 1])]
            sums = np.zeros(len(own) + 1, _U)
            np.cumsum(_VALUE[own] * _UP[: len(own)], dtype=_U, out=sums[1:])
            a, b = starts[at:stop] - first, ends[at:stop] - first
            out[at:stop] = mix((sums[b] - sums[a]) * _DOWN[a] + (b - a).astype(_U))
            at = stop
    return out


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    return edge[::2], edge[1::2]


def _repeated(words: np.ndarray) -> int:
    """Words that lie in a window of WINDOW words which the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    factors = stream(31, WINDOW) | _U(1)
    with np.errstate(over="ignore"):
        window = mix(sum((words[k : k + n] * factors[k] for k in range(WINDOW)), np.zeros(n, _U)))
    _, where, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[where] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(raw: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of the UTF-8 bytes of one text."""
    gap = SEPARATOR[raw]
    starts, ends = _runs(~gap)
    chars = int(np.count_nonzero(((raw & 0xC0) != 0x80) & ~gap))
    feeds = np.flatnonzero(raw == 10)
    line_starts, line_ends = np.append(0, feeds + 1), np.append(feeds, len(raw))
    spoken = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[spoken], line_ends[spoken]
    lines = len(line_starts)
    dup = lines - len(np.unique(_span_hashes(raw, line_starts, line_ends))) if lines > 1 else 0
    return len(starts), chars, int(np.count_nonzero(SYMBOLS[raw])), dup, _repeated(_span_hashes(raw, starts, ends)) if len(starts) > WINDOW else 0


def compression(raw: bytes | memoryview, compressor: zstandard.ZstdCompressor) -> tuple[float | None, int, int]:
    """(ratio, bytes in chunks below the band, bytes in chunks above it); chunks shorter than CHUNK are not judged."""
    raw = memoryview(raw)
    if not len(raw):
        return None, 0, 0
    low = high = 0
    if len(raw) >= 2 * CHUNK:
        for k in range(0, len(raw) - CHUNK + 1, CHUNK):
            ratio = len(compressor.compress(raw[k : k + CHUNK])) / CHUNK
            low, high = low + CHUNK * (ratio < CHUNK_BAND[0]), high + CHUNK * (ratio > CHUNK_BAND[1])
    return len(compressor.compress(raw)) / len(raw), low, high


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_bytes, ratio, low_bytes, high_bytes, verdict) for each row of docs (doc_id, text).

    word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``; n_dup_lines: lines with a word that equal an
    earlier one; n_repeat_words: words in windows of eight words that the text has twice or more.  base_failed: fewer than
    20 words, or more than 30 percent of them repeated.  verdict: ``base``, ``repetitive`` or ``incompressible`` (the ratio of the
    whole document is outside the band of its length), ``repetitive chunks`` or ``incompressible chunks`` (at least
    CHUNK_SHARE percent of its bytes lie in such chunks; from two chunks on), or ``ok``, which alone is kept.
    Null and empty texts have no words and fail the base rules; the ratio of a text without bytes is null.  Every row is
    judged by its whole text alone, so nulls in other columns, ties, repeated rows and more columns change nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            raw, offs = text_buffers(batch.column("text"))
            for a, b in groups_of_rows(offs):
                texts = [raw[offs[k] : offs[k + 1]] for k in range(a, b)]
                base, packed = [measure(t) for t in texts], [compression(memoryview(t), compressor) for t in texts]
                columns = [pa.array([x[k] for x in base], pa.int64()) for k in range(5)] + [pa.array(np.diff(offs[a : b + 1]))] + [pa.array([x[k] for x in packed], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], names=["doc_id", *_MEASURES])

    m = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} {'double' if c == 'ratio' else 'long'}" for c in _MEASURES))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    least, most = F.lit(None).cast("double"), F.lit(None).cast("double")
    for size, low, high in BANDS:
        least, most = (F.when(F.col("n_bytes") >= size, F.lit(x)).otherwise(y) for x, y in ((low, least), (high, most)))
    share = lambda c: F.col(c) * 100 >= F.col("n_bytes") * CHUNK_SHARE
    verdict = F.when(F.col("base_failed"), "base").when(F.col("ratio") < least, "repetitive").when(F.col("ratio") > most, "incompressible")
    verdict = verdict.when((F.col("low_bytes") > 0) & share("low_bytes"), "repetitive chunks").when((F.col("high_bytes") > 0) & share("high_bytes"), "incompressible chunks").otherwise("ok")
    out = m.withColumn("base_failed", failed).withColumn("verdict", verdict)
    return out.select("doc_id", *_MEASURES[:5], "base_failed", (F.col("verdict") == "ok").alias("kept"), *_MEASURES[5:], "verdict")


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "ratio", "low_bytes", "high_bytes")

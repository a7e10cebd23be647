"""Words, shingles and MinHash coordinates of whole Arrow text columns, by numpy.

A word is a maximal run of bytes outside space, tab, LF, VT, FF and CR; A-Z count as a-z.
Bytes of many texts are hashed together in pieces of about a megabyte, so memory stays
bounded whatever the length of a text; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(_U(seed) + np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BYTE = stream(11, 256)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, PIECE + 65536)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            one = np.full(size, base, _U)
            one[0] = 1
            _POWERS[name] = np.cumprod(one, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows together and the rows' offsets in them; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def groups_of_rows(offs: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``piece`` bytes; a longer row stands alone."""
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + piece, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def _words_of_piece(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``raw``; no word crosses one of ``bounds``."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    gap = SEPARATOR[raw]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    before[inner] = True
    after[inner - 1] = True
    solid = ~gap
    starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, _U)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[raw] * up[:n], dtype=_U, out=total[1:])
        hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))
    return starts, hashes


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows between ``offs``: each word's row and 64-bit hash, in order."""
    n = len(raw)
    if n <= 2 * PIECE:
        starts, hashes = _words_of_piece(raw, offs)
        return np.searchsorted(offs, starts, "right") - 1, hashes
    rows, out, at = [], [], 0
    while at < n:
        end = min(n, at + PIECE)
        while end < n:  # go on to a gap, so that no word is cut
            gaps = np.flatnonzero(SEPARATOR[raw[end : end + 65536]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(n, end + 65536)
        starts, hashes = _words_of_piece(raw[at:end], offs - at)
        rows.append(np.searchsorted(offs, starts + at, "right") - 1)
        out.append(hashes)
        at = end
    return np.concatenate(rows), np.concatenate(out)


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, offsets, hashes): the rows' distinct k-word shingles, sorted in each row.

    A row with fewer than k words has its whole sequence as one shingle; a row without words has none.
    """
    raw, offs = text_buffers(column)
    weights = stream(23, k) | _U(1)
    for a, b in groups_of_rows(offs):
        local = offs[a : b + 1] - offs[a]
        row, word = word_hashes(raw[offs[a] : offs[b]], local)
        n_words = np.bincount(row, minlength=b - a) if len(row) else np.zeros(b - a, np.int64)
        counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
        ends = np.cumsum(counts)
        first_word = np.cumsum(n_words) - n_words
        with np.errstate(over="ignore"):
            full = np.zeros(0, _U)
            if len(word) >= k:
                full = word[: len(word) - k + 1] * weights[0]
                for j in range(1, k):
                    full = full + word[j : len(word) - k + 1 + j] * weights[j]
                full = mix(full)
            out = np.empty(int(ends[-1]), _U)
            long = n_words >= k
            if long.any():
                inside = np.zeros(len(full) + 1, np.int64)
                np.add.at(inside, first_word[long], 1)
                np.add.at(inside, first_word[long] + n_words[long] - k + 1, -1)
                keep = np.cumsum(inside[:-1]) > 0
                place = np.repeat(long, counts)
                out[place] = full[keep]
            for r in np.flatnonzero((n_words > 0) & ~long):
                w = word[first_word[r] : first_word[r] + n_words[r]]
                out[ends[r] - 1] = mix(np.array([(w * weights[: len(w)]).sum(dtype=_U) + _U(len(w))], _U))[0]
        start = ends - counts
        for s, e in zip(start.tolist(), ends.tolist()):
            if e - s > 1:
                out[s:e].sort()
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[start[counts > 0]] = True
        kept = np.concatenate([[0], np.cumsum(fresh)])
        yield a, b, np.concatenate([[0], kept[ends]]), out[fresh]


def minima(offsets: np.ndarray, hashes: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """MinHash: for each row with shingles, the least value under each of ``size`` hash functions (rows x size)."""
    some = offsets[1:] > offsets[:-1]
    at = offsets[:-1][some]
    out = np.empty((len(at), size), _U)
    if len(at):
        factors, shifts = stream(seed, size) | _U(1), stream(seed + 1, size)
        with np.errstate(over="ignore"):
            for k in range(size):
                out[:, k] = np.minimum.reduceat((hashes ^ shifts[k]) * factors[k], at)
    return out


def list_array(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow list<long> column from offsets and 64-bit values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def as_unsigned(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and 64-bit values of a list<long> column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs = column.offsets.to_numpy().astype(np.int64)
    return offs - offs[0], column.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]].view(np.uint64)

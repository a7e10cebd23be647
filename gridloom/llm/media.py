"""Media columns: AVI files of motion JPEG.

``write_avi`` stores bytes without loss as the AC coefficients of grey baseline JPEG frames: with unit quantisers a
coefficient of size category 8 has 8 amplitude bits, one for each of 256 values, and with a single one-bit Huffman
code before them a block of 63 coefficients is 1 + 63 * 9 bits, exactly 71 bytes.  ``read_avi`` walks the RIFF
chunks, finds the frames by the ``idx1`` index and decodes each one's tables and entropy-coded blocks.  ``shots``
cuts where the histograms of decoded frames differ by more than their running mean and spread allow.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

UNIT = 64
SIDE, BLOCKS, PER_BLOCK, BLOCK_BYTES = 32, 16, 63, 71
FRAME = BLOCKS * PER_BLOCK
RATE = 25
BINS, SPREAD, FLOOR = 32, 3.0, 0.02
#: Frames encoded or decoded together, so that memory stays bounded for long texts.
TOGETHER = 512

_ANGLE = (2 * np.arange(8)[:, None] + 1) * np.arange(8)[None, :] * np.pi / 16
_ONE = np.cos(_ANGLE) * np.where(np.arange(8) == 0, np.sqrt(0.125), 0.5)
#: Zigzag order: by anti-diagonals, up and down in turn.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i % 8 if (i // 8 + i % 8) % 2 == 0 else i // 8)))
#: Row i: pixels of a block whose i-th coefficient in zigzag order is 1.
_BASIS = np.einsum("yu,xv->uvyx", _ONE, _ONE).reshape(64, 64)[ZIGZAG].astype(np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_HEAD = (
    b"\xff\xd8"
    + _segment(0xDB, b"\0" + b"\1" * 64)
    + _segment(0xC0, struct.pack(">BHHB3B", 8, SIDE, SIDE, 1, 1, 0x11, 0))
    + _segment(0xC4, b"\x00" + bytes([1] + [0] * 15) + b"\0")
    + _segment(0xC4, b"\x10" + bytes([1] + [0] * 15) + b"\x08")
    + _segment(0xDA, b"\1\1\0\0\x3f\0")
)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(payload: bytes) -> bytes:
    """An AVI file (RIFF, one MJPG stream, idx1) whose frames hold ``payload``; the stream's strd chunk has its length."""
    count = max(1, -(-len(payload) // FRAME))
    movi, index, at = [b"movi"], [], 4
    for a in range(0, count, TOGETHER):
        n = min(TOGETHER, count - a)
        part = np.zeros(n * FRAME, np.uint8)
        own = np.frombuffer(payload, np.uint8, max(0, min(len(payload) - a * FRAME, n * FRAME)), min(a * FRAME, len(payload))) if payload else part[:0]
        part[: len(own)] = own
        bits = np.zeros((n * BLOCKS, BLOCK_BYTES * 8), np.uint8)
        bits[:, 1:].reshape(n * BLOCKS, PER_BLOCK, 9)[:, :, 1:] = np.unpackbits(part.reshape(-1, PER_BLOCK, 1), axis=2)
        coded = np.packbits(bits, axis=1).tobytes()
        size = BLOCKS * BLOCK_BYTES
        for k in range(n):
            image = _HEAD + coded[k * size : (k + 1) * size].replace(b"\xff", b"\xff\0") + b"\xff\xd9"
            movi.append(_chunk(b"00dc", image))
            index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(image)))
            at += len(movi[-1])
    main = struct.pack("<14I", 1_000_000 // RATE, 0, 0, 0x10, count, 0, 1, 0, SIDE, SIDE, 0, 0, 0, 0)
    stream = struct.pack("<4s4sIHHIIIIIIII4h", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, count, 0, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    bitmap = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 24, b"MJPG", SIDE * SIDE * 3, 0, 0, 0, 0)
    strl = b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", bitmap) + _chunk(b"strd", struct.pack("<Q", len(payload)))
    head = b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", strl)
    return _chunk(b"RIFF", b"AVI " + _chunk(b"LIST", head) + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def chunks(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, body start, body end) of the RIFF chunks in a span; a LIST's name is that of its kind."""
    at = start
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", data, at)
        if at + 8 + size > end:
            raise ValueError("a RIFF chunk goes beyond its parent")
        if name == b"LIST":
            yield data[at + 8 : at + 12], at + 12, at + 8 + size
        else:
            yield name, at + 8, at + 8 + size
        at += 8 + size + size % 2


def _tables(image: memoryview) -> tuple[dict, bytes]:
    """Header fields of a baseline JPEG, and its entropy-coded bytes without stuffing."""
    raw, at, head = bytes(image), 2, {"huffman": {}}
    if raw[:2] != b"\xff\xd8":
        raise ValueError("no JPEG image")
    while True:
        marker, size = raw[at + 1], struct.unpack_from(">H", raw, at + 2)[0]
        body = raw[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            head["quant"] = np.frombuffer(body, np.uint8, 64, 1)
        elif marker == 0xC0:
            head["height"], head["width"], head["parts"] = struct.unpack_from(">HHB", body, 1)
        elif marker == 0xC4:
            head["huffman"][body[0]] = (tuple(body[1:17]), body[17:])
        elif marker == 0xDA:
            return head, raw[at : raw.rindex(b"\xff\xd9")].replace(b"\xff\0", b"\xff")


def _one_by_one(head: dict, coded: bytes, blocks: int) -> np.ndarray:
    """Coefficients (blocks x 64, zigzag) by any Huffman tables: the general, slow way."""
    codes = {}
    for which, (lengths, symbols) in head["huffman"].items():
        code, k, codes[which] = 0, 0, {}
        for length, n in enumerate(lengths, 1):
            for _ in range(n):
                codes[which][length, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
    bits, at, dc = np.unpackbits(np.frombuffer(coded, np.uint8)).tolist(), 0, 0
    out = np.zeros((blocks, 64), np.int32)

    def symbol(which: int) -> int:
        nonlocal at
        code = length = 0
        while (length, code) not in codes[which]:
            code, length, at = code << 1 | bits[at], length + 1, at + 1
        return codes[which][length, code]

    def value(size: int) -> int:
        nonlocal at
        v = 0
        for b in bits[at : at + size]:
            v = v << 1 | b
        at += size
        return v if not size or v >> (size - 1) else v - (1 << size) + 1

    for b in range(blocks):
        dc += value(symbol(0x00))
        out[b, 0], k = dc, 1
        while k < 64:
            run, size = divmod(symbol(0x10), 16)
            if not size:
                if run != 15:
                    break
                k += 16
                continue
            k += run
            out[b, k], k = value(size), k + 1
    return out


def decode(images: list[memoryview]) -> np.ndarray:
    """Coefficients (frames x blocks x 64, zigzag order) of grey frames of one size."""
    out: list[np.ndarray | None] = [None] * len(images)
    plain, coded = [], []
    for k, image in enumerate(images):
        head, body = _tables(image)
        if head["parts"] != 1:
            raise ValueError("only grey frames are read")
        blocks = (head["height"] + 7) // 8 * ((head["width"] + 7) // 8)
        lone = all(h[0] == (1,) + (0,) * 15 for h in head["huffman"].values())
        if lone and head["huffman"][0x00][1] == b"\0" and head["huffman"][0x10][1] == b"\x08" and blocks == BLOCKS and (head["quant"] == 1).all():
            plain.append(k)
            coded.append(body)
        else:
            out[k] = _one_by_one(head, body, blocks) * head["quant"].astype(np.int32)
    if plain:
        bits = np.unpackbits(np.frombuffer(b"".join(coded), np.uint8).reshape(-1, BLOCK_BYTES), axis=1)
        value = np.packbits(bits[:, 1:].reshape(-1, PER_BLOCK, 9)[:, :, 1:], axis=2)[:, :, 0].astype(np.int32)
        all_at_once = np.zeros((len(value), 64), np.int32)
        all_at_once[:, 1:] = np.where(value < 128, value - 255, value)
        for k, x in zip(plain, all_at_once.reshape(len(plain), BLOCKS, 64)):
            out[k] = x
    return np.stack(out)


def read_avi(data: bytes) -> Iterator[tuple[np.ndarray, bytes]]:
    """Yield (coefficients, payload bytes) of an AVI file's frames, some hundred frames at a time, found by the index."""
    view, left = memoryview(data), None
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    top = {name: (a, b) for name, a, b in chunks(data, 12, 8 + struct.unpack_from("<I", data, 4)[0])}
    for name, a, b in chunks(data, *top[b"hdrl"]):
        if name == b"strl":
            inner = {x: (c, d) for x, c, d in chunks(data, a, b)}
            left = struct.unpack_from("<Q", data, inner[b"strd"][0])[0]
    base = top[b"movi"][0] - 4
    places = np.frombuffer(data, "<u4", (top[b"idx1"][1] - top[b"idx1"][0]) // 4, top[b"idx1"][0]).reshape(-1, 4)
    for a in range(0, len(places), TOGETHER):
        found = decode([view[base + int(o) + 8 : base + int(o) + 8 + int(n)] for o, n in places[a : a + TOGETHER, 2:]])
        value = found[:, :, 1:].reshape(-1)
        payload = np.where(value < 0, value + 255, value).astype(np.uint8).tobytes()[:left]
        left -= len(payload)
        yield found, payload


def histograms(coefficients: np.ndarray) -> np.ndarray:
    """Luminance histograms (frames x BINS, shares) of decoded frames."""
    pixels = np.clip(coefficients.reshape(-1, 64).astype(np.float32) @ _BASIS + 128, 0, 255.9)
    bins = (pixels * (BINS / 256)).astype(np.int64).reshape(len(coefficients), -1) + np.arange(len(coefficients))[:, None] * BINS
    return np.bincount(bins.reshape(-1), minlength=len(coefficients) * BINS).reshape(-1, BINS) / bins.shape[1]


def shots(hist: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) frames of each shot: a cut is where the histogram difference exceeds the shot's mean by SPREAD deviations and FLOOR."""
    cuts, n, mean, square = [0], 0, 0.0, 0.0
    for k, d in enumerate((np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2).tolist(), 1):
        if n >= 2 and d > mean + SPREAD * max(0.0, square - mean * mean) ** 0.5 + FLOOR:
            cuts.append(k)
            n, mean, square = 0, 0.0, 0.0
            continue
        n += 1
        mean += (d - mean) / n
        square += (d * d - square) / n
    return list(zip(cuts, [*cuts[1:], len(hist)]))


def clips_of(data: bytes) -> tuple[list[dict], bytes]:
    """Timed clips of an AVI file, one for each shot, and the payload read back."""
    hist, payload = [], []
    for found, part in read_avi(data):
        hist.append(histograms(found))
        payload.append(part)
    h = np.concatenate(hist)
    level = h @ ((np.arange(BINS) + 0.5) * (256 / BINS))
    rows = [{"clip": k, "start_s": a / RATE, "end_s": b / RATE, "frames": b - a, "luma": round(float(level[a:b].mean()), 2)} for k, (a, b) in enumerate(shots(h))]
    return rows, b"".join(payload)


def media_clips(media: DataFrame) -> DataFrame:
    """(media_id, clip, start_s, end_s, frames, luma) of AVI files (media_id, content); a null file has no clips."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if data.is_valid:
                    rows = [{"media_id": key} | c for c in clips_of(data.as_py())[0]]
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([("media_id", pa.int64()), ("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32()), ("luma", pa.float64())]))

    return media.select(F.col("media_id").cast("long"), "content").mapInArrow(run, "media_id long, clip int, start_s double, end_s double, frames int, luma double")


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("clips", pa.int32()), ("seconds", pa.float64())])


def media_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, clips, seconds) of each document.

    The text's UTF-8 bytes (null: none), filled with zeros to a positive multiple of 64, are written as an AVI file; that
    file is read again, and checksums and clips come from what was read.  feature lists the clips as start-end:luma; equal
    texts give equal values.  Every row is kept, null doc_ids and repeated rows too; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                n = len(data)
                media = write_avi(data + bytes(-n % UNIT or (0 if n else UNIT)))
                clips, payload = clips_of(media)
                feature = ";".join(f"{c['start_s']:.2f}-{c['end_s']:.2f}:{c['luma']:.2f}" for c in clips)
                rows.append({
                    "doc_id": key, "n_bytes": n, "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-UNIT:]),
                    "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "feature": feature, "clips": len(clips), "seconds": clips[-1]["end_s"],
                })
                size += len(feature)
                if len(rows) >= 1024 or size > 1 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _DIGEST)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _DIGEST)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips int, seconds double")

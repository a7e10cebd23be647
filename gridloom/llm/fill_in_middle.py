"""Fill-in-the-middle documents by a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its text, and the
three sentinels.  Cutting a document splits a descriptor, a form arranges the descriptors and those of the sentinels,
and hashes read the descriptors one after the other, so no text is copied until an output is asked for.  A restored
text is made from the output alone: its sentinels cut it into descriptors, and the inverse of the form's
arrangement puts these in order again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import groups_of_rows, text_buffers

#: The sentinels before prefix, suffix and middle.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Parts of a cut document in order of the text, and their order in each form's output.
PARTS = ("prefix", "middle", "suffix")
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PIECE = 1 << 24
_MARKS = b"".join(SENTINELS.values())

Descriptor = tuple[int, int, int]


class PieceTable:
    """Descriptors over buffers (text, sentinels); the order of the descriptors is the document."""

    def __init__(self, text: bytes | memoryview, pieces: list[Descriptor] | None = None):
        self.buffers = (memoryview(text), memoryview(_MARKS))
        self.pieces = [(0, 0, len(text))] if pieces is None else pieces

    def cut(self, *at: int) -> PieceTable:
        """Split at these offsets of the document, in rising order; an offset at an end or given twice makes an empty piece."""
        out: list[Descriptor] = []
        before, left = 0, list(at)
        for buffer, start, length in self.pieces:
            last = 0
            while left and left[0] <= before + length:
                out.append((buffer, start + last, left[0] - before - last))
                last = left.pop(0) - before
            out.append((buffer, start + last, length - last))
            before += length
        return PieceTable(self.buffers[0], out)

    def arranged(self, order: list[int | Descriptor]) -> PieceTable:
        """Descriptors by number, or new ones, in this order."""
        return PieceTable(self.buffers[0], [self.pieces[k] if isinstance(k, int) else k for k in order])

    def __iter__(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start : start + length]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for piece in self:
            h.update(piece)
        return h.hexdigest()

    def text(self) -> bytes:
        return b"".join(self)


def _mark(part: str) -> Descriptor:
    return 1, _MARKS.index(SENTINELS[part]), len(SENTINELS[part])


def _order(form: str) -> list[int | Descriptor]:
    """The form's arrangement of the three pieces of a cut text."""
    return [x for part in FORMS[form] for x in (_mark(part), PARTS.index(part))]


def restored_pieces(output: bytes, form: str) -> PieceTable | None:
    """The text of an output as descriptors over it; None where the form is unknown or its sentinels are not there."""
    if form == "plain":
        return PieceTable(output)
    if form not in FORMS:
        return None
    ends, at = [], 0
    for k, part in enumerate(FORMS[form]):
        at = output.find(SENTINELS[part], at)
        if at < 0 or (k == 0 and at):
            return None
        ends += [at, at + len(SENTINELS[part])]
        at = ends[-1]
    cut = PieceTable(output).cut(*ends)  # an empty piece, then a sentinel and a part in turn
    return cut.arranged([2 + 2 * FORMS[form].index(part) for part in PARTS])


def _characters(raw: np.ndarray) -> int:
    """Code points of UTF-8 bytes, a piece at a time."""
    return sum(int(np.count_nonzero((raw[k : k + PIECE] & 0xC0) != 0x80)) for k in range(0, len(raw), PIECE))


def _line_ends(raw: np.ndarray) -> np.ndarray:
    """Offsets behind the lines of a text; the last line need not end in a line feed."""
    ends = np.concatenate([np.zeros(0, np.int64), *(np.flatnonzero(raw[k : k + PIECE] == 10) + k + 1 for k in range(0, len(raw), PIECE))])
    return ends if not len(raw) or (len(ends) and ends[-1] == len(raw)) else np.append(ends, len(raw))


def _transform(raw: np.ndarray, h: tuple[int, int, int, int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, PieceTable]:
    """(lines, form, prefix_chars, middle_chars, output) of one text."""
    text, ends = raw.tobytes(), _line_ends(raw)
    n, table = len(ends), PieceTable(text)
    if not len(text) or h[2] % 100 >= rate or any(s in text for s in SENTINELS.values()):
        return n, "plain", None, None, table
    a, b = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, _characters(raw[:a]), _characters(raw[a:b]), table.cut(a, b).arranged(_order(form))


_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string"


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, output) for each row of docs (doc_id, text).

    A text is cut between lines into prefix, middle and suffix; the first four 8-digit groups of the sha256 of
    ``seed:doc_id`` choose the two cuts, whether the document is transformed (``rate`` percent are) and whether it comes as
    suffix-prefix-middle (``spm`` percent) or prefix-suffix-middle.  Null and empty texts and texts that hold a sentinel
    stay plain.  A row without a doc_id is hashed as ``seed:``; repeated rows come out alike, each in a row of its own; other
    columns are not used.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffers(batch.column("text"))
            draws = list(zip(*(batch.column(f"h{k}").to_pylist() for k in range(1, 5))))
            for a, b in groups_of_rows(offs, PIECE):
                found = [_transform(raw[offs[k] : offs[k + 1]], draws[k], rate, spm) for k in range(a, b)]
                columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns, pa.array([x[4].sha256() for x in found], pa.string()), pa.array([x[4].text() for x in found], pa.binary()).cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *h).mapInArrow(run, _OUT + ", output string")


def restore(outputs: DataFrame, texts: bool = True) -> DataFrame:
    """outputs (form, output and other columns) with restored_sha256, and with ``texts`` the restored text, in place of ``output``.

    Only output and form are used.  Both are null where the output is null, the form is unknown, or its sentinels are not there.
    """
    others = [f for f in outputs.schema if f.name not in ("output", "restored", "restored_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, column = batch.column("form").to_pylist(), batch.column("output")
            _, offs = text_buffers(column)
            for a, b in groups_of_rows(offs, PIECE):
                found = [None if (o := column[k]).as_py() is None else restored_pieces(o.as_buffer().to_pybytes(), forms[k]) for k in range(a, b)]
                made = [pa.array([x and x.sha256() for x in found], pa.string())]
                if texts:
                    made.append(pa.array([x and x.text() for x in found], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name).slice(a, b - a) for f in others), *made], names=[*(f.name for f in others), "restored_sha256", "restored"][: len(others) + len(made)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others) + ", restored_sha256 string" + ", restored string" * texts
    return outputs.select(*(f"`{f.name}`" for f in others), "output").mapInArrow(run, schema)

"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

A record is a header, an empty line, the payload and two line ends; the text sink writes exactly that when the
line separator is the two line ends.  A reader task scans a whole file for the magic and emits each candidate
with the offset of its successor; since payloads may hold the magic too, only candidates that a chain of
successors reaches from a file's start are records, found by pointer jumping in joins.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..tables import settle, work_path

MAGIC, BREAK = b"WARC/1.1\r\n", "\r\n\r\n"
LEAST_BYTES = 100
#: A file has at most so many records, and so few that records of mean size make up the bytes; larger records are written to
#: files of fewer records, so that no file is larger than four times the bytes or one record: what a reader task holds.
FILE_RECORDS, FILE_BYTES, FEWER = 4000, 64 << 20, 16
#: A header without its url is smaller.
HEADER = 512
#: A payload's pages are dealt over so many groups, so that the pages of a very common payload don't meet in one task.
GROUPS = 1024
URN = "urn:page:"
#: Fixed value of the WARC standard: the profile of a revisit whose payload has the digest of an earlier one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _revisits(sizes: DataFrame) -> DataFrame:
    """(page_id_, digest_, original) of the pages (page_id, digest) whose payload a page of a lower page_id has, that is the original.

    Pages meet by digest and group, groups by digest, so that neither is unbounded; payloads are not shuffled for it.
    """
    sizes = sizes.select("page_id", "digest", F.pmod(F.xxhash64("page_id"), F.lit(GROUPS)).alias("group"))
    groups = sizes.groupBy("digest", "group").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    first = groups.groupBy("digest").agg(F.min("least").alias("original"), F.sum("n").alias("n")).where("n > 1 and original is not null").drop("n")
    known = groups.select("digest", "group").join(first, "digest")
    found = sizes.join(known, ["digest", "group"]).where(~F.col("page_id").eqNullSafe(F.col("original")))
    return settle(found.select(F.col("page_id").alias("page_id_"), F.col("digest").alias("digest_"), "original").distinct(), "revisits")


def _tiers(records: int) -> list[tuple[int, int, int | None]]:
    """(records in a file, bytes that a record exceeds, bytes that it does not exceed) of each kind of file; the last kind has one record of any size."""
    out, above = [], 0
    while records > 1:
        most = 4 * FILE_BYTES // records
        out.append((records, above, most))
        above, records = most, max(1, records // FEWER)
    return [*out, (1, above, None)]


def write_archive(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write pages (page_id, url, html) as WARC records under ``path``.

    Of pages with equal payloads of at least ``least`` bytes the one with the least page_id is a response, the others are
    revisits without payload; smaller payloads are all responses.  A null html is an empty payload.  WARC-Date is the time of
    writing; a row without a page_id gets a random record id, rows that repeat a page_id share theirs.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), body.alias("body"), F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"))
    sizes = settle(rows.select("page_id", "bytes", "digest", (F.octet_length("url") + HEADER).alias("room")), "digests")
    typed = rows.join(_revisits(sizes.where(F.col("bytes") >= least)), [rows["page_id"].eqNullSafe(F.col("page_id_")), rows["digest"] == F.col("digest_")], "left").drop("page_id_", "digest_")
    again = F.col("original").isNotNull()
    mean = sizes.agg(F.avg("bytes")).first()[0] or 0
    tiers = _tiers(min(FILE_RECORDS, max(1, int(FILE_BYTES // (mean + HEADER)))))
    within = lambda size, above, most: (size > above) & (size <= most if most is not None else F.lit(True))
    found = sizes.agg(*[F.count_if(within(F.col("room"), a, m) | within(F.col("room") + F.col("bytes"), a, m)) for _, a, m in tiers]).first()
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    urn = lambda key: F.concat(F.lit(f"<{URN}"), key.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))), line("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")), line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(F.col("original"))))).otherwise(""), line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("bytes")).cast("string")), F.lit(BREAK),
    )
    room = F.octet_length("url") + HEADER + F.when(again, 0).otherwise(F.col("bytes"))
    for (records, above, most), n in zip(tiers, found):
        if n or above == 0:
            part = typed.where(within(room, above, most)).select(F.concat(head, F.when(again, "").otherwise(F.col("body"))).alias("value"))
            part.write.mode("append").option("lineSep", BREAK).option("maxRecordsPerFile", records).text(path)


_FIELDS = pa.schema([("file", pa.int64()), ("at", pa.int64()), ("next", pa.int64()), ("type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("said", pa.string()), ("bytes", pa.int64()), ("digest", pa.string())])


def _files(path: str, spark) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")


def candidates(path: str, spark) -> DataFrame:
    """(file, at, next, type, page_id, refers_to, url, said, bytes, digest): each place in each file that parses as a record.

    said is the digest by the header, digest that of the bytes; a candidate that begins inside one that was hashed is not hashed
    (null), since both can't be records.  So no byte is hashed twice, however many headers a payload holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = re.compile(re.escape(BREAK.encode()))
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                view, rows, hashed = memoryview(data), [], 0
                for m in re.finditer(re.escape(MAGIC), view):
                    if m.start() and bytes(view[max(0, m.start() - 4) : m.start()]) != BREAK.encode():
                        continue  # a record starts the file or follows another's end; so headers of candidates don't overlap
                    close = blank.search(view, m.start())
                    if not close:
                        continue
                    end = close.start()
                    head = dict(x.split(": ", 1) for x in bytes(view[m.end() : end]).decode("utf-8", "replace").split("\r\n") if ": " in x)
                    if not head.get("Content-Length", "").isdecimal():
                        continue
                    start = end + 4
                    after = start + int(head["Content-Length"]) + 4
                    if after > len(view) or bytes(view[after - 4 : after]) != BREAK.encode():
                        continue
                    digest = None
                    if m.start() >= hashed:
                        hashed, digest = after, hashlib.sha256(view[start : after - 4]).hexdigest()
                    number = lambda name: int(x[0]) if (x := re.findall(rf"^<{URN}(-?\d+)>$", head.get(name, ""))) else None
                    rows.append({
                        "file": file, "at": m.start(), "next": after, "type": head.get("WARC-Type"), "page_id": number("WARC-Record-ID"), "refers_to": number("WARC-Refers-To"), "url": head.get("WARC-Target-URI"),
                        "said": head.get("WARC-Payload-Digest", "").removeprefix("sha256:"), "bytes": after - 4 - start, "digest": digest,
                    })
                yield pa.RecordBatch.from_pylist(rows, _FIELDS)

    return _files(path, spark).select(F.xxhash64("path").alias("file"), "content").mapInArrow(run, "file long, at long, next long, type string, page_id long, refers_to long, url string, said string, bytes long, digest string")


def reachable(found: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, at, next) that a chain of successors reaches from offset 0 of their file.

    Pointer jumping: in each round every candidate's pointer skips twice as far, and what a reached candidate points at
    is reached; the rounds are the logarithm of the records in a file.
    """
    found = found.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("live")).dropDuplicates(["file", "at"])
    starts = found.select("file", F.col("at").alias("to"), F.lit(True).alias("known"))
    now = settle(found.join(starts, ["file", "to"], "left").select("file", "at", "to", "live", F.coalesce("known", F.lit(False)).alias("open")), "chain")
    before = -1
    while (n := now.where("live").count()) != before:
        before = n
        # open pointers lead to a candidate; those that have left the chain, all to their file's end, join nothing
        jump = now.select("file", F.col("at").alias("to"), F.col("to").alias("further"), F.col("open").alias("on"))
        hit = now.where("live and open").select("file", F.col("to").alias("at")).distinct().withColumn("hit", F.lit(True))
        moved = now.where("open").join(jump, ["file", "to"]).select("file", "at", F.col("further").alias("to"), "live", F.col("on").alias("open"))
        moved = moved.unionByName(now.where("not open"))
        now = settle(moved.join(hit, ["file", "at"], "left").select("file", "at", "to", (F.col("live") | F.coalesce("hit", F.lit(False))).alias("live"), "open"), "chain")
    return now.where("live").select("file", "at")


def read_archive(path: str, spark) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the verified records under ``path``.

    A response's length and digest are those of the bytes read; a revisit's are its response's, found by page and digest.
    A file whose chain of records does not end at the file's end is an error.
    """
    found = settle(candidates(path, spark), "candidates")
    records = settle(found.join(reachable(found), ["file", "at"]).drop("at"), "records")
    ends = records.groupBy("file").agg(F.max("next").alias("end"))
    cut = _files(path, spark).select("path", "length", F.xxhash64("path").alias("file")).join(ends, "file", "left").where("end is null or end <> length").first()
    if cut:
        raise ValueError(f"{cut.path}: the chain of records ends at {cut.end or 0} of {cut.length} bytes")
    responses = records.where("type = 'response'")
    full = responses.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("said")).agg(F.max("bytes").alias("full"))
    revisits = records.where("type = 'revisit'").join(full, ["refers_to", "said"])
    return responses.select("page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(
        revisits.select("page_id", "url", "full", "said", "type", "refers_to")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` (page_id, url, html) after an archive of them is written in the shared folder and read back.

    Every row has one record: nulls in any column, empty and long payloads, payloads with the magic inside, repeated
    rows (both responses) and rows without a page_id (a revisit if another page has the payload).  Other columns are ignored.
    """
    path = work_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(path, pages.sparkSession)

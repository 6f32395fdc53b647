"""WARC archives kept as a chunked record table.

An archive is a table of (archive, record, chunk_no, data) rows; the data of
an archive's rows in that order are the bytes of a WARC 1.1 file. A payload
is written and read chunk by chunk, each chunk with the digest of the payload
up to its end, so neither side holds a whole record and a damaged chunk is
found where it is.

Reading needs nothing but the table: headers are parsed from the bytes, and
lengths and digests are taken from the chunks as they pass.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship_package, stage

CHUNK_BYTES = 64 * 1024
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # the tables carry no crawl time
END = b"\r\n\r\n"
_CHUNKS = "archive int, record bigint, chunk_no int, kind string, data binary, digest string"
_ROWS_TOGETHER = 128


def _header(kind: str, record_id: str, url: str | None, length: int, digest: str, total: int, refers_to: int | None) -> bytes:
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", target)] if target else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(total))]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _record_id(refers_to, digest))]
    fields += [("Content-Type", "text/html;charset=utf-8"), ("Content-Length", str(length))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def _record_id(page_id: int | None, digest: str, place: str = "") -> str:
    """A record's id. The one response of a payload that revisits may name
    needs no more than the digest; any other record adds its place."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}{place and ':'}{place}>"


def _page_id(record_id: str) -> int | None:
    digits = record_id.removeprefix("<urn:x-page:").split(":")[0]
    return int(digits) if digits else None


def parse_header(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, sha1, refers_to and revisit for every row.

    Of pages with equal payloads of at least ``min_bytes`` bytes exactly one is
    the response: the one with the smallest page_id (a missing id is larger
    than any), of rows that repeat it one. Digests alone meet in the
    aggregate; only revisits, by far the fewer, are joined back to the pages,
    by id and digest. Where that does not tell the response from its copies,
    the rows are first written with their places.
    """
    payload = F.coalesce("html", F.lit(""))
    sha1 = F.sha1(payload.cast("binary"))
    digests = stage(pages.select("page_id", sha1.alias("sha1"), F.octet_length(payload).alias("size"))
                    .where(F.col("size") >= min_bytes).groupBy("sha1", "page_id").count(), "digests")
    by_id = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "count")).alias("first")
    first = stage(digests.groupBy("sha1").agg(by_id, F.sum("count").alias("n")).where("n > 1"), "first")
    if first.where("first.count > 1").limit(1).count() == 0:
        revisits = stage(digests.join(first, "sha1").where("not page_id <=> first.page_id")
                         .select(F.col("page_id").alias("again"), F.col("sha1").alias("sha1_again"),
                                 F.col("first.page_id").alias("refers_to")), "revisits")
        html = pages.select("page_id", "url", payload.alias("html"), sha1.alias("sha1"))
        same = F.col("page_id").eqNullSafe(F.col("again")) & (F.col("sha1") == F.col("sha1_again"))
    else:
        html = stage(pages.select("page_id", "url", payload.alias("html"), sha1.alias("sha1"),
                                  F.monotonically_increasing_id().alias("place")), "placed")
        rows = html.where(F.octet_length("html") >= min_bytes).select("page_id", "sha1", "place")
        by_place = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "place")).alias("first")
        # written, so that the join below has plain exchanges and a payload many rows share is split
        first = stage(rows.groupBy("sha1").agg(by_place, F.count("*").alias("n")).where("n > 1"), "first")
        revisits = stage(rows.join(first, "sha1").where("place <> first.place")
                         .select(F.col("place").alias("again"), F.col("sha1").alias("sha1_again"),
                                 F.col("first.page_id").alias("refers_to")), "revisits")
        same = F.col("place") == F.col("again")
    return html.join(revisits, same, "left").select(
        "page_id", "url", "html", "sha1", "refers_to", F.col("sha1_again").isNotNull().alias("revisit"))


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) and return
    the chunk table as written: archive, record, chunk_no, kind, data, digest.
    Each task writes one archive; a null payload is empty."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, record = TaskContext.get().partitionId(), -1
        rows: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "sha1", "refers_to", "revisit")]
            for page_id, url, html, sha1, refers_to, revisit in zip(*columns):
                record += 1
                # a view of the batch's buffer: chunks are cut without a copy of the whole payload
                view = memoryview(html.as_buffer())
                digest, total = base32(bytes.fromhex(sha1.as_py())), len(view)
                kind = "revisit" if revisit.as_py() else "response"
                body = view[:0] if revisit.as_py() else view
                alone = kind == "response" and total >= min_bytes
                record_id = _record_id(page_id.as_py(), digest, "" if alone else f"{archive}.{record}")
                head = _header(kind, record_id, url.as_py(), len(body), digest, total, refers_to.as_py())
                rows.append((archive, record, 0, "header", head, ""))
                running = hashlib.sha1()
                number = 0
                for at in range(0, len(body), chunk_bytes):
                    piece, number = bytes(body[at:at + chunk_bytes]), number + 1
                    running.update(piece)
                    rows.append((archive, record, number, "payload", piece, base32(running.digest())))
                    if len(rows) >= _ROWS_TOGETHER:
                        yield _batch(rows)
                        rows = []
                rows.append((archive, record, number + 1, "end", END, ""))
            if rows:
                yield _batch(rows)
                rows = []

    return stage(record_types(pages, min_bytes).mapInArrow(run, _CHUNKS), "warc")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.string())
    names = ["archive", "record", "chunk_no", "kind", "data", "digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(chunks: DataFrame) -> DataFrame:
    """Read a chunk table back: page_id, payload_bytes, payload_digest,
    record_type, refers_to for every record. Chunks are put in order by a
    sort and pass one at a time; a record with a wrong length or digest, or
    without an end, fails the read."""
    ship_package(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        where, fields, running, size, open_ = None, {}, hashlib.sha1(), 0, False
        for batch in batches:
            for archive, record, kind, data, digest in zip(*(batch.column(c) for c in ("archive", "record", "kind", "data", "digest"))):
                kind = kind.as_py()
                if kind == "header":
                    if open_:
                        raise ValueError(f"record {where} has no end")
                    where, open_ = (archive.as_py(), record.as_py()), True
                    fields, running, size = parse_header(data.as_py()), hashlib.sha1(), 0
                elif not open_ or where != (archive.as_py(), record.as_py()):
                    raise ValueError(f"chunk of {archive.as_py()}, {record.as_py()} without its record")
                elif kind == "payload":
                    view = memoryview(data.as_buffer())
                    running.update(view)
                    size += len(view)
                    if base32(running.digest()) != digest.as_py():
                        raise ValueError(f"record {where} is damaged before byte {size}")
                else:
                    open_ = False
                    out.append(_read_record(where, fields, size, base32(running.digest())))
            if out:
                yield _records(out)
                out = []
        if open_:
            raise ValueError(f"record {where} has no end")

    ordered = chunks.repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk_no")
    return ordered.mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def _read_record(where, fields: dict[str, str], size: int, digest: str) -> tuple:
    declared, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if size != int(fields["Content-Length"]) or kind == "response" and digest != declared:
        raise ValueError(f"record {where} has a wrong length or digest")
    refers_to = _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _page_id(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), declared, kind, refers_to


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as archives and read them back.

    Of every group of equal payloads one record is the response, whatever ids
    its rows have: a null page_id is larger than any other, and of rows that
    repeat the smallest id one is the response, the others revisit it. If no
    row of a group has an id, ``refers_to`` is null for its revisits too.
    Record ids are distinct. An empty table gives an empty result.
    """
    return read_archives(write_archives(pages, min_bytes, chunk_bytes))


def export_archive(chunks: DataFrame, archive: int) -> Iterator[bytes]:
    """The bytes of one archive, chunk by chunk, as a WARC file has them."""
    rows = chunks.where(F.col("archive") == archive).orderBy("record", "chunk_no").select("data")
    for row in rows.toLocalIterator():
        yield bytes(row.data)

"""WARC archives: a writer, and a splittable reader of gzip members.

Archives are sequences of gzip members, one record each.  Spark's text source
reads them: with the gzip magic as its line separator, a task scans its byte
range for the magic and owns the pieces that start inside, on any file system
that Spark reaches.  A piece is only a candidate member.  It counts as a member
when its gzip header, its stream and the record header inside decode; when the
magic occurs inside compressed data, the pieces are put together again, also
over the border of two ranges.

Defined results: a null payload is an empty one; a null url or id is written as
an empty value and read back as null; records of any size are kept whole;
repeated rows are repeated records; an empty table gives an empty archive, which
reads back as no records.  Files must not end in .gz: Hadoop would unpack such
a file as one stream in one task.  Only the named columns are used.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm.common import blocks
from lakefold.session import fresh_path

MAGIC = b"\x1f\x8b\x08"
LEAST_SHARED = 1000  # bytes: equal payloads of at least this size are stored once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
               "payload_bytes bigint, payload binary")
PIECE_SCHEMA = f"{READ_SCHEMA}, file string, range_start bigint, place bigint, fragment binary"


def gzip_member(data: bytes) -> bytes:
    """One gzip member with a plain 10-byte header (no time, so re-runs write the same bytes)."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def record_bytes(record_id: str, uri: str, digest: str, payload: bytes, size: int, refers_to: str | None) -> bytes:
    """A response record, or a revisit record (whose block is the HTTP header alone)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{record_id}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """record_id, uri, payload, digest, size, refers_to: which record of equal payloads holds them.

    Digests are grouped without the payloads, and only groups of two or more go
    into the join, so one digest with a third of all pages is a few partial rows
    on one side and a skewed join that Spark splits on the other.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("record_id"), F.col(url).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload").cast("bigint"))
    holders = (rows.filter(F.col("size") >= LEAST_SHARED).groupBy(F.col("digest").alias("_d"))
               .agg(F.max("record_id").alias("holder"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    joined = rows.join(holders, (F.col("digest") == F.col("_d")) & (F.col("size") >= LEAST_SHARED), "left")
    other = F.col("holder").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("holder"))
    return joined.select("record_id", "uri", F.when(~other, F.col("payload")).alias("payload"), "digest", "size",
                         F.when(other, F.col("holder")).alias("refers_to"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write planned records as archives under `path`, one file per task.

    Spark's text writer puts a zero byte after each row.  The last byte of a
    gzip member is the top byte of its size, zero below 16 MiB, so that byte is
    left to the writer; after a larger member the zero byte is padding.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "payload"):
            out = []
            for r in block.to_pylist():
                member = gzip_member(record_bytes("" if r["record_id"] is None else r["record_id"], r["uri"] or "", r["digest"],
                                                  r["payload"] or b"", r["size"], r["refers_to"]))
                out.append(member[:-1] if member[-1] == 0 else member)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    text = records.select(F.col("record_id").cast("string").alias("record_id"), "uri", "payload", "digest", "size",
                          F.col("refers_to").cast("string").alias("refers_to"))
    text.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


_HTTP_SIZE = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.I)


def parse_record(data: bytes) -> tuple | None:
    """The READ_SCHEMA values of a whole record; None if it is not one."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    size = fields.get(b"content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        return None
    block = rest[:int(size)]
    kind = fields.get(b"warc-type", "")
    if block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
    else:
        http, payload = b"", block
    digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
    if kind == "revisit":  # the payload is in the record it refers to
        found = _HTTP_SIZE.search(http)
        n = int(found[1]) if found else None
        digest, payload = fields.get(b"warc-payload-digest", "").rpartition(":")[2].lower() or None, None
    name = lambda f: fields.get(f, "").strip("<>").removeprefix("urn:page:") or None
    return (name(b"warc-record-id"), kind, fields.get(b"warc-target-uri") or None, name(b"warc-refers-to"), digest, n, payload)


def candidate(data: bytes) -> tuple[str, tuple | None]:
    """("member", record) if header, gzip stream and record decode to their end; "open" if the
    stream goes on behind `data`; "bad" otherwise."""
    if len(data) < 10:
        return "open", None
    if data[:3] != MAGIC or data[3] & 0xE0:
        return "bad", None
    unpack = zlib.decompressobj(31)
    try:
        body = unpack.decompress(data)
    except zlib.error:
        return "bad", None
    if not unpack.eof:
        return "open", None
    fields = parse_record(body)
    return ("member", fields) if fields is not None else ("bad", None)


class Stitcher:
    """Takes candidate pieces in file order and gives records; what is none goes out as a fragment."""

    def __init__(self):
        self.held: tuple[bytes, int] | None = None  # a member that goes on, and the place of its start

    def take(self, piece: bytes, place: int) -> Iterator[tuple[tuple | None, bytes | None, int]]:
        """(record, None, place) or (None, fragment, place)."""
        if self.held is not None:
            state, fields = candidate(self.held[0] + piece)
            if state == "open":
                self.held = (self.held[0] + piece, self.held[1])
                return
            start, self.held = self.held, None
            if state == "member":
                yield fields, None, start[1]
                return
            yield None, *start  # the held start was no member: the piece is tried alone
        state, fields = candidate(piece)
        if state == "member":
            yield fields, None, place
        elif state == "open":
            self.held = (piece, place)
        else:
            yield None, piece, place

    def rest(self) -> Iterator[tuple[None, bytes, int]]:
        if self.held is not None:
            yield None, *self.held
            self.held = None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                   ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload", pa.binary())])
_PIECE = pa.schema([*_READ, ("file", pa.string()), ("range_start", pa.int64()), ("place", pa.int64()), ("fragment", pa.binary())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of byte ranges to records and fragments."""
    span, place, stitch = (None, None), 0, Stitcher()

    def rows(found):
        return [(*(fields or (None,) * 7), *span, at, fragment) for fields, fragment, at in found]

    for block in blocks(batches, "value"):
        out = []
        for value, file, start in zip(*(block.column(i).to_pylist() for i in range(3))):
            if (file, start) != span:
                out += rows(stitch.rest())  # it goes on in the next range
                span, place = (file, start), 0
                if start == 0:  # what stands before a file's first magic
                    out += rows([(None, value, 0)]) if value.strip(b"\0") else []
                    continue
            place += 1
            out += rows(stitch.take(MAGIC + value, place))
        if out:
            yield _batch(out, _PIECE)
    if out := rows(stitch.rest()):
        yield _batch(out, _PIECE)


def _join_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments in file order to records; what stays without one is a row of type "damaged"."""
    file, stitch = None, Stitcher()

    def rows(found):
        return [fields or (None, "damaged", file, None, None, len(fragment), fragment) for fields, fragment, _ in found]

    for block in blocks(batches, "fragment"):
        out = []
        for name, fragment in zip(*(block.column(i).to_pylist() for i in (0, 3))):
            if name != file:
                out += rows(stitch.rest())
                file = name
            out += rows(stitch.take(fragment, 0))
        if out:
            yield _batch(out, _READ)
    if out := rows(stitch.rest()):
        yield _batch(out, _READ)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (READ_SCHEMA) of the archives under `path`; bytes that belong to
    no record come back as rows of type "damaged"."""
    pieces = (spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("range_start")))
    found = pieces.mapInArrow(_scan, PIECE_SCHEMA)
    names = _READ.names
    fragments = found.filter("fragment IS NOT NULL").select("file", "range_start", "place", "fragment")
    joined = (fragments.repartition("file").sortWithinPartitions("file", "range_start", "place")
              .mapInArrow(_join_fragments, READ_SCHEMA))
    return found.filter("fragment IS NULL").select(*names).unionByName(joined)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back: one row per page."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(plan_records(pages), path)
    return read_archives(spark, path).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"), F.col("target_uri").alias("url"))

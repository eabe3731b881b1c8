"""WARC archives: writing them, and a reader that salvages damaged ones.

Writing: a record's head and payload are one value of Spark's text writer, whose line end is set to the blank lines
that end a record, so archives are written by the same committed, retried tasks as any table, to any file system.
Records with equal payloads are written once, as the response with the largest id; the others are revisits.

Reading: each archive is scanned from record to record. A record counts if its version line, head, length, end and
digests hold. If one does not, the reader looks for the next place where a valid record starts (a gzip member or a
version line, whatever the archive began with), goes on there, and logs the bytes between as a gap with the reason.
The block digest is that of the whole block. The payload digest is that of the body after the HTTP head in records of
type application/http (as sent, or put together from its chunks), else of the block; those of revisits and segments refer to
other records too and are not compared. Digests are SHA-1, SHA-256 or MD5 in base 32 or hexadecimal.

An archive is read by one task, so the writer bounds the records of one; a single page may be as long as Spark's
rows may be.

Defined results: null payloads are empty; null ids come before all others. Rows equal in id and payload are all
responses if theirs is the largest id. Line ends in an url are percent-encoded. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kohortflow.session import cut_lineage

ARCHIVE_RECORDS = 2000
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
MEMBER = b"\x1f\x8b\x08"
STARTS = (*VERSIONS, MEMBER)
STEP = 1 << 16  # compressed bytes taken at a time
NONE = -(1 << 63)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 160 bits are eight groups of five hexadecimal and four base-32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), BASE32HEX, BASE32)


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to, revisit) of (page_id, url, html).

    Of equal payloads of at least ``least`` bytes, the largest id is the response.
    """
    payload = F.coalesce("html", F.lit(""))
    described = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NONE)).alias("id"), base32_sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    largest = described.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = described.join(largest, ["digest", "bytes"]).where("id < first").select("id", "digest", "first").distinct()
    again = cut_lineage(again)  # its size is known then, so that pages are shuffled only if it is large
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NONE)).alias("id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload").cast("long")})
    return rows.join(again, ["id", "digest"], "left").select(
        F.when(F.col("id") != NONE, F.col("id")).alias("page_id"), "url", "payload", "digest", "bytes", F.col("first").alias("refers_to"), F.col("first").isNotNull().alias("revisit")
    )


def write(rows: DataFrame, path: str, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Archives of ``records`` below ``path``, uncompressed, one record after the other."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    named = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    revisit = F.col("revisit")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", named(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT)), line("WARC-Refers-To", named(F.col("refers_to"))))).otherwise(""),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    value = F.concat(head, F.when(revisit, "").otherwise(F.col("payload")))
    out = rows.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", archive_records)
    out.text(path)


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Head, payload and end of the record at ``at``, or what is wrong with it."""
    if not data.startswith(VERSIONS, at):
        return "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return "head does not end"
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
    head = dict(fields)
    if any(":" not in x for x in lines) or any([k for k, _ in fields].count(name) > 1 for name in ("warc-type", "warc-record-id", "content-length")):
        return "head runs into another record"
    length = head.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no length"
    start, stop = end + 4, end + 4 + int(length)
    if stop > len(data):
        return "shorter than its length"
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "does not end where its length says"
    payload = data[start:stop]
    if not _agrees(head.get("warc-block-digest", ""), [payload]):
        return "block digest differs"
    whole = head.get("warc-type") != "revisit" and "warc-segment-number" not in head
    if whole and not _agrees(head.get("warc-payload-digest", ""), _bodies(head, payload)):
        return "digest differs"
    return head, payload, stop + 4


def _agrees(field: str, bodies: list[bytes]) -> bool:
    """Is the digest that of one of the ``bodies``? One of an unknown kind is taken as it is."""
    kind, _, digest = field.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("sha1", "sha256", "md5"):
        return True
    made = [hashlib.new(kind, body, usedforsecurity=False).digest() for body in bodies]
    digest = digest.strip().upper().rstrip("=")
    return any(digest in (base64.b32encode(d).decode().rstrip("="), d.hex().upper()) for d in made)


def _bodies(head: dict[str, str], block: bytes) -> list[bytes]:
    """What a payload digest may be of."""
    if head.get("content-type", "").partition(";")[0].strip().lower() != "application/http":
        return [block]
    top, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return [b"", block]
    if not re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", top, re.I):
        return [body]
    parts, at = [], 0
    while size := re.compile(rb"([0-9a-fA-F]+)[^\r\n]*\r\n").match(body, at):
        n = int(size[1], 16)
        parts.append(body[size.end() : size.end() + n])
        at = size.end() + n + 2
        if not n:
            break
    return [body, b"".join(parts)]


def _next(data: bytes, at: int, marks: tuple[bytes, ...]) -> int:
    found = [i for i in (data.find(m, at) for m in marks) if i >= 0]
    return min(found, default=len(data))


def salvage(data: bytes) -> Iterator[tuple[int, int, str, dict[str, str], bytes]]:
    """(place, length, fault, head, payload) of all of an archive: records have no fault, gaps no head.

    Places are those in the archive as it is stored; in a compressed one a record has the place of its member.
    """
    at, gap, fault = 0, -1, ""
    while at < len(data):
        got = _member(data, at) if data.startswith(MEMBER, at) else _record(data, at)
        if isinstance(got, str):
            gap, fault = (at, got) if gap < 0 else (gap, fault)
            at = _next(data, at + 1, STARTS)
            continue
        if gap >= 0:
            yield gap, at - gap, fault, {}, b""
            gap = -1
        if isinstance(got[0], list):
            parts, size = got
            for bad, head, payload in parts:
                yield at, size, bad, head, payload
            at += size
        else:
            yield at, got[2] - at, "", got[0], got[1]
            at = got[2]
    if gap >= 0:
        yield gap, len(data) - gap, fault, {}, b""


def _member(data: bytes, at: int) -> tuple[list[tuple[str, dict[str, str], bytes]], int] | str:
    """Records and gaps of the gzip member at ``at`` and its length, or what is wrong with it."""
    member, plain, stop = zlib.decompressobj(31), [], at
    try:
        while stop < len(data) and not member.eof:
            part = data[stop : stop + STEP]
            plain.append(member.decompress(part))
            stop += len(part)
    except zlib.error as e:
        return f"member: {e}"
    if not member.eof:
        return "member does not end"
    parts = [p[2:] for p in salvage(b"".join(plain))]
    if parts and all(fault for fault, _, _ in parts):
        return parts[0][0]
    return parts, stop - at - len(member.unused_data)


READ = pa.schema([("archive", pa.string()), ("place", pa.int64()), ("length", pa.int64()), ("fault", pa.string()), ("head", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0), batch.column(1), strict=True):
            rows: list[tuple] = []
            for place, length, fault, head, payload in salvage(data.as_py()):
                rows.append((path.as_py(), place, length, fault, list(head.items()), payload if payloads else None))
                if len(rows) >= 200:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in READ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, READ, strict=True)], schema=READ)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records and gaps of the archives below ``path``: (archive, place, length, fault, head, payload)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(lambda b: _read(b, payloads), "archive string, place long, length long, fault string, head map<string,string>, payload binary")


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return found.where("fault <> ''").select("archive", "place", "length", "fault")


def round_trip(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Write all pages, read the archives: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    write(records(pages, least), path)
    found = read(pages.sparkSession, path, payloads=False).where("fault = ''")
    number = lambda key: F.expr(f"try_cast(regexp_extract(head['{key}'], '<urn:page:(-?[0-9]+)>', 1) AS bigint)")
    kind = F.col("head")["warc-type"]
    return found.select(
        number("warc-record-id").alias("page_id"),
        F.col("head")["x-payload-length"].cast("long").alias("payload_bytes"),
        F.substring_index(F.col("head")["warc-payload-digest"], ":", -1).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(kind == "revisit", number("warc-refers-to")).alias("refers_to"),
    )

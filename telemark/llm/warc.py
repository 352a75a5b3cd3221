"""WARC archives: a writer with revisit records and a splittable reader.

``write`` finds equal payloads with one aggregation of digests and one join; every record is a gzip
member of its own.  Each task writes its files under new names and reports them; only reported files
belong to the archive, so lost or repeated attempts leave nothing that is read.

``read`` gives tasks byte ranges.  A task scans its range for the gzip magic, takes a candidate only
if it inflates to a WARC header, and owns the records that start inside; from a valid record on it
follows the chain of members, reading past the end of its range where the last one reaches further.
A member that does not decode is passed over by scanning on from the next byte.

Edge cases: null html is the empty payload; a null url gives no target header; a null page id is
written as an id that only the digest names, is never referred to, and is read back as null.  Rows
that share the largest page id of their payload are all responses.  No pages: no files, no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark import TaskContext

from telemark.llm.files import NewFile, open_input
from telemark.llm.shared import dealt, durable

FILE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 18
LEVEL = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
MAGIC = b"\x1f\x8b\x08"
ID = "urn:telemark:page:"

RECORDS = "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, digest, size, refers_to and payload (null for revisits) of every record to write."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    repeated = (
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "owner")
    )
    joined = rows.join(repeated, "digest", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return joined.select(
        "page_id", "url", "digest", "size",
        F.when(revisit, F.col("owner")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes | None) -> bytes:
    """One WARC record, not compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    name = page_id if page_id is not None else f"none:{digest}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html); returns the archive's files: path, bytes, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, records = TaskContext.get().partitionId(), None, 0

        def finished() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_pydict({"path": [file.path], "bytes": [file.size], "records": [records]})

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "refers_to", "payload"))):
                if file is None:
                    file, records = NewFile(folder, f"part-{part:06d}", ".warc.gz"), 0
                file.write(gzip.compress(record(*row), LEVEL, mtime=0))
                records += 1
                if file.size >= file_bytes:
                    yield finished()
                    file = None
        if file is not None:
            yield finished()

    return durable(plan(pages, min_bytes).mapInArrow(run, "path string, bytes long, records long"), "archive")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Files of an archive written elsewhere: path and bytes; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


def read(files: DataFrame, payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of ``files`` (path, bytes).  Payload and digest are the entity's, without HTTP headers;
    those of a revisit are what its headers say of the entity it stands for."""
    ranges = files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("begin")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, begin in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "begin"))):
                rows, held = [], 0
                for row in scan(path, begin, min(begin + split_bytes, size), size, payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 512
                    if held >= 16 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    return dealt(ranges, "path", "begin").mapInArrow(run, RECORDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _member(source, at: int, size: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at ``at`` and where the next begins; None if it holds no WARC record."""
    inflate, parts, begun, position = zlib.decompressobj(31), [], b"", at
    try:
        while not inflate.eof:
            if position >= size:
                return None
            source.seek(position)
            raw = source.read(READ_BYTES)
            position += len(raw)
            parts.append(inflate.decompress(raw))
            if len(begun) < 7:
                begun = b"".join(parts)[:7]
                if not b"WARC/1.".startswith(begun):
                    return None
    except zlib.error:
        return None
    content = b"".join(parts)
    if not content.startswith(b"WARC/1."):
        return None
    return content, position - len(inflate.unused_data)


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records in one member (as a rule one)."""
    at = 0
    while content.startswith(b"WARC/1.", at):
        stop = content.index(b"\r\n\r\n", at)
        headers = _headers(content[at:stop])
        length = int(headers.get("content-length", 0))
        yield headers, content[stop + 4 : stop + 4 + length]
        at = stop + 4 + length + 4


def scan(path: str, begin: int, end: int, size: int, payload: bool) -> Iterator[tuple]:
    """Rows of the records that start in [begin, end) of a file of ``size`` bytes."""
    with open_input(path) as source:
        at = begin
        while at < end:
            source.seek(at)
            window = source.read(min(READ_BYTES, end - at) + len(MAGIC) - 1)
            found = window.find(MAGIC)
            if found < 0:
                at += max(1, len(window) - len(MAGIC) + 1)
                continue
            at += found
            if at >= end:
                break
            member = _member(source, at, size)
            if member is None:
                at += 1
                continue
            content, following = member
            for headers, block in records(content):
                yield _row(path, at, headers, block, payload)
            at = following


def _row(path: str, at: int, headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind = headers.get("warc-type")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    body, length = block, len(block)
    if "application/http" in headers.get("content-type", ""):
        head, _, body = block.partition(b"\r\n\r\n")
        declared = _headers(head).get("content-length")
        length = int(declared) if kind == "revisit" and declared is not None else len(body)
    if kind != "revisit":
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    bare = lambda name: re.sub(r"^<|>$", "", headers[name]) if name in headers else None
    return (
        path, at, kind, bare("warc-record-id"), headers.get("warc-target-uri"), bare("warc-refers-to"), length, digest,
        body if payload and kind != "revisit" else None,
    )


def page_id(record_id):
    """The page id in a record id column, null where there is none."""
    digits = F.regexp_extract(record_id, f"^{ID}(-?[0-9]+)$", 1)
    return F.when(digits != "", digits.cast("long"))

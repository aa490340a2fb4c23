"""WARC archives, index first.

Writing: one pass over the pages takes narrow digests and finds, per payload, the smallest page id;
that decision then meets the pages in one join, and each task writes the records it holds to
archives of its own, one gzip member per record, so that a record can be read by its byte range. The
task returns the index: archive, offset, length, URL, digest. A task that is run again writes new
archives under new names; only the index of the attempt that succeeded counts.

Reading: selected index rows are sorted by archive and offset; neighbouring ranges are coalesced
into reads of bounded size, and each record is cut out, parsed and its payload checked against its
digest.

Archives are reached through ``pyarrow.fs`` (local and shared folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import staged

# Bytes after which a task begins its next archive; bytes of an archive that are read by one task,
# and of all that a task reads; largest gap that a coalesced read bridges, and its largest size.
ARCHIVE_BYTES, SPLIT_BYTES, TASK_BYTES, GAP_BYTES, READ_BYTES = 1 << 30, 8 << 20, 128 << 20, 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "archive string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: each 5 hex digits are 4 base32 digits."""
    digest = F.sha1(payload)
    part = lambda i: F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[part(i) for i in range(1, 41, 5)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    for scheme in ("s3a", "s3n"):
        if folder.startswith(f"{scheme}://"):
            folder = "s3" + folder[len(scheme) :]
    if "://" not in folder:
        folder = folder if folder.startswith("file:") else f"file://{folder}"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head, with the payload's length, but no payload."""
    name = lambda i: "null" if i is None else str(i)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name(page_id)}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{name(refers_to)}>"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload_bytes, digest, payload or None) of one record; checks the digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda key: None if (s := field.get(key, "null").removeprefix("<urn:page:").removesuffix(">")) == "null" else int(s)
    if field["WARC-Type"] == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its digest")
    else:
        payload = None
    return number("WARC-Record-ID"), field.get("WARC-Target-URI"), field["WARC-Type"], number("WARC-Refers-To"), size, digest, payload


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """Distinct (page_id, payload_digest, first) of ``pages(page_id, html)``: first is the page to refer to, or null.

    Payloads of at least ``least`` bytes that several pages share are written once, with the
    smallest page id; rows that repeat that id are responses too. Pages without an id refer to the
    smallest known one; if none is known they are all responses.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    narrow = staged(
        pages.select("page_id", base32_sha1(payload).alias("payload_digest"), F.octet_length(payload).alias("bytes")).distinct(), "warc-digests"
    )
    shared = narrow.where(F.col("bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = staged(shared.where("n > 1").select("payload_digest", "first"), "warc-shared")
    met = narrow.join(shared, "payload_digest", "left")
    # `bytes` needs no key: equal digests have equal lengths.
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    return met.select("page_id", "payload_digest", F.when(other, F.col("first")).alias("first"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; return the stored index, one row per row of pages.

    Null html is an empty payload; a null url is left out of the record. Other columns are
    ignored. An empty table gives an empty index and no archive.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", base32_sha1(F.col("payload")))
    decided = decide(pages, least)
    known = lambda df: df.withColumns({"_id": F.coalesce("page_id", F.lit(0)), "_null": F.col("page_id").isNull()})
    joined = known(rows).join(known(decided).drop("page_id"), ["_id", "_null", "payload_digest"])
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            index = []
            for page_id, url, payload, digest, first in zip(*batch.columns, strict=True):
                if out is None or offset >= archive_bytes:
                    if out is not None:
                        out.close()
                    else:
                        store.create_dir(root, recursive=True)
                    name, offset = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                args = page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py()
                refers = first.as_py()
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record(*args, refers is not None, refers)) + packer.flush()
                out.write(member)
                index.append((name, offset, len(member), args[0], args[1], args[3], "response" if refers is None else "revisit"))
                offset += len(member)
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*index), schema, strict=True)], schema=schema)
        if out is not None:
            out.close()

    return staged(joined.select("page_id", "url", "payload", "payload_digest", "first").mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the given index rows, read by coalesced byte ranges.

    Columns page_id, url, record_type, refers_to, payload_bytes and payload_digest (of the full
    payload, also for revisits), and payload if asked for (null for revisits). A record that does
    not match its digest or its index row raises.
    """
    share = F.floor(F.col("offset") / SPLIT_BYTES)
    # Tasks by the bytes to read, not by the size of the index.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)
    ranges = (
        index.select("archive", "offset", "length", "payload_digest", share.alias("share"))
        .repartition(tasks, "archive", "share")
        .sortWithinPartitions("archive", "offset")
        .drop("share")
    )
    kind = RECORD + (", payload binary" if with_payload else "")
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    schema = pa.schema(fields + ([("payload", pa.binary())] if with_payload else []))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        run: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run and (row[0] != run[0][0] or row[1] - (run[-1][1] + run[-1][2]) > GAP_BYTES or row[1] + row[2] - run[0][1] > READ_BYTES):
                    yield run
                    run = []
                run.append(row)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        file, name = None, ""
        for run in runs(batches):
            if run[0][0] != name:
                if file is not None:
                    file.close()
                name = run[0][0]
                file = store.open_input_file(f"{root}/{name}")
            begin = run[0][1]
            data = file.read_at(run[-1][1] + run[-1][2] - begin, begin)
            rows = []
            for _, offset, length, digest in run:
                row = parse(gzip.decompress(data[offset - begin : offset - begin + length]))
                if row[5] != digest:
                    raise ValueError(f"record at {offset} of {name} is not the one the index names")
                rows.append(row if with_payload else row[:6])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
        if file is not None:
            file.close()

    return ranges.mapInArrow(read, kind)


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, least), folder)


def oracle_sql() -> str:
    """DuckDB: base32 by five-bit groups of the SHA-1."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = "array_to_string(list_transform(string_split(sha1(payload), ''), lambda h: lpad(bin(('0x' || h)::int), 4, '0')), '')"
    return f"""
with base as (select page_id, encode(coalesce(html, '')) as payload from pages),
hashed as (select page_id, octet_length(payload)::bigint as payload_bytes, payload, {bits} as bits from base),
named as (
  select page_id, payload_bytes, payload,
    array_to_string(list_transform(range(0, 32), lambda i: substr('{digits}',
      list_sum(list_transform(range(0, 5), lambda j: (substr(bits, (i * 5 + j + 1)::bigint, 1) = '1')::int * (1 << (4 - j))))::int + 1, 1)), '') as payload_digest
  from hashed),
met as (select *, min(page_id) over (partition by payload) as first from named)
select page_id, payload_bytes, payload_digest,
  case when page_id = first or first is null then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from met"""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from articlelake.llm import warc
from articlelake.session import scratch_path

from .helpers import LONG

KIND = "page_id long, url string, html string, payload string, first long, archive int"
PAGES = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"),
    (1, "http://a/1", None), (2, None, ""), (4, "x: y\r\nz", "é日\r\n\r\nWARC/1.1\r\n"), (None, "http://n", "<p>same</p>"), (None, "http://m", "alone"),
    (None, "http://m2", "twice"), (None, "http://m3", "twice"), (7, "http://long", LONG), (3, "http://other", "<p>same</p>"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND)


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw]
        first = min((j for j in same if j is not None), default=None)
        revisit = len(raw) >= least and first is not None and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 1, 12])
def test_pages_come_back(spark, least):
    assert found(warc.archive_pages(frame(spark, PAGES), least)) == expected(PAGES, least)


def test_small_reads_and_archives(spark, monkeypatch):
    """Every limit small: many archives, runs that end by gap and by size."""
    for name, value in {"GAP_BYTES": 10, "READ_BYTES": 300, "SPLIT_BYTES": 500}.items():
        monkeypatch.setattr(warc, name, value)
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(frame(spark, PAGES).coalesce(1), folder, archive_bytes=700)
    assert index.select("archive").distinct().count() > 1
    assert found(warc.read_records(index, folder)) == expected(PAGES)
    some = index.where(F.col("page_id").isin(3, 4, 7))
    payloads = {(r.page_id, r.record_type): r.payload for r in warc.read_records(some, folder, with_payload=True).collect()}
    assert bytes(payloads[4, "response"]).decode() == PAGES[6][2] and bytes(payloads[7, "response"]).decode() == LONG


def test_archives_are_plain_warc(spark):
    """Read from the first byte, without the index: the members are whole records in a row."""
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(frame(spark, PAGES), folder).collect()
    root = folder.removeprefix("file://")
    total = 0
    for name in os.listdir(root):
        raw = gzip.decompress(open(f"{root}/{name}", "rb").read())
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: re")
            size = int(head.rpartition(b"Content-Length: ")[2])
            assert rest[size : size + 4] == b"\r\n\r\n"
            raw, total = rest[size + 4 :], total + 1
    assert total == len(PAGES) == len(index)


def test_a_changed_archive_fails(spark):
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(frame(spark, PAGES[:1]), folder)
    other = index.withColumn("payload_digest", F.lit("A" * 32))
    with pytest.raises(Exception, match="not the one the index names"):
        warc.read_records(other, folder).collect()


def test_empty_table(spark):
    assert warc.archive_pages(frame(spark, [])).count() == 0


def test_digest_equals_the_library(spark):
    texts = ["", "a", "é" * 99]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32_sha1(F.col("t").cast("binary")).alias("d")).collect()
    assert [r.d for r in rows] == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]

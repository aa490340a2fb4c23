import hashlib
import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from articlelake.llm import fingerprints as fp

from .helpers import documents, empty, odd


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain(text):
    """Lanes of a text, paragraph by paragraph and clause by clause."""
    equal = [0] * fp.EQUAL_LANES
    for line in (text or "").split("\n"):
        digest = hashlib.sha256(line.encode()).hexdigest().encode()
        for i in range(fp.EQUAL_LANES):
            # Spark's xxhash64 of (string, int): the second value is hashed with the first hash as seed.
            seed = xxhash.xxh64_intdigest(digest, 42)
            equal[i] += int32_hash(i + 1, seed) & 0xFFFFFFFF
    clauses = [c for c in re.split(r"[\n.,]", text or "") if c]
    hashes = [xxhash.xxh64_intdigest(c.encode(), 42) for c in clauses]
    pairs = [sum((h >> g) & fp._PAIR for h in hashes) for g in range(fp.LIKE_BITS)]
    return [x % fp.EQUAL_MOD for x in equal] + [len(clauses)] + pairs


def int32_hash(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed)


TEXTS = ["", "one", "one\ntwo. three, four", "two. three, four\none", "a\n\nb", "\n", "Ünï; cödé | x\n" * 50]


def vectors(spark, texts):
    docs = documents(spark, list(enumerate(texts)))
    return {r.doc_id: r.vector for r in fp.fingerprint(docs).collect()}


def test_lanes_equal_plain_sums(spark):
    got = vectors(spark, TEXTS)
    assert {i: plain(t) for i, t in enumerate(TEXTS)} == got


def test_order_does_not_matter_but_counts_do(spark):
    v = vectors(spark, ["a\nb\nc", "c\na\nb", "a\nb\nc\nc", "a\nb"])
    assert v[0] == v[1] and v[0] != v[2] and v[0] != v[3]


def test_insertion_and_deletion(spark):
    v = vectors(spark, ["a. x\nb\nc", "a. x\nb", "c"])
    frame = spark.createDataFrame([(v[0], v[1], v[2])], "whole array<long>, part array<long>, more array<long>")
    row = frame.select(fp.insert(F.col("part"), F.col("more")).alias("i"), fp.delete(F.col("whole"), F.col("more")).alias("d")).first()
    assert row.i == v[0] and row.d == v[1]


def expected(rows):
    """Edited texts by sorting all rows: descending id, null ids last, equal ids by text."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_a_range", [1, 3, 1000])
def test_edited_texts(spark, monkeypatch, rows_a_range):
    monkeypatch.setattr(fp.with_next, "__defaults__", (rows_a_range,))
    rows = [(i * i - 50, f"document {i} " * (i % 5 + 1)) for i in range(40)] + [(10**15, "far away")] + [(None, "no id"), (None, "none"), (-50, "again")]
    got = fp.edit_report(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == expected(rows)


def test_likeness(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = fp.edit_report(docs).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for r in got:
        assert seen.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(seen.values())) == len(seen)


def test_likeness_of_equal_and_empty(spark):
    got = fp.edit_report(documents(spark, [(1, "a. b\nc"), (2, "c\na. b"), (3, "")])).collect()
    by = {r.doc_id: r for r in got}
    assert by[2].near_next == 1.0 and by[3].near_next == 0.0 and by[3].near_edited == 1.0
    one = fp.edit_report(documents(spark, [(1, "only text")])).first()
    assert one.near_next == 1.0 and math.isclose(one.near_edited, one.near_edited)


def test_odd_rows(spark):
    got = fp.edit_report(odd(spark)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[1].fingerprint == by[2].fingerprint and by[1].n_chars == 0
    assert {r.fingerprint for r in got if r.doc_id in (6, 7)} == {by[6].fingerprint}
    assert fp.edit_report(empty(spark)).count() == 0


def test_only_null_ids(spark):
    assert fp.edit_report(documents(spark, [(None, "abc"), (None, "abd")])).count() == 2


def test_main_path_is_native(spark, sf):
    plan = fp.edit_report(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))

import bisect
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from articlelake.llm import packing as pk

from .helpers import ODD, documents, empty, odd

LIBRARY = Tokenizer.from_file(pk.default_vocabulary())


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def sequential(lengths, window):
    """Best-fit decreasing, one piece at a time; remaining capacities of the open windows, sorted."""
    open_, used = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(open_, n)
        if k == len(open_):
            used, rest = used + 1, window - n
        else:
            rest = open_.pop(k) - n
        if rest:
            bisect.insort(open_, rest)
    return used, open_


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=300))
def test_plan_equals_sequential_best_fit(lengths):
    window = 64
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = pk.best_fit(counts, window)
    used, open_ = sequential(lengths, window)
    assert plan.windows == used
    fill = {}
    for n, many in counts.items():
        at, offset = plan.place(np.full(many, n), np.arange(many))
        for a, o in zip(at.tolist(), offset.tolist(), strict=True):
            fill.setdefault(a, []).append((o, n))
    rest = []
    for parts in fill.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= window
        rest.append(window - end)
    assert sorted(r for r in rest if r) == open_ and len(fill) == used


def test_plan_size_does_not_follow_the_corpus():
    rng = random.Random(1)
    counts = {n: rng.randint(1, 50) for n in range(1, 2048)}
    large = {n: c * 1_000_003 for n, c in counts.items()}
    assert len(pk.best_fit(large).length) < 20_000


def test_tightest_capacity():
    tree = pk.Capacities(64)
    for c in (3, 17, 40):
        tree.put(c, 0, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 17, 18, 40, 41, 64)] == [3, 3, 17, 17, 40, 40, None, None]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet=st.characters(max_codepoint=0x27F), max_size=60))
def test_ids_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert pk.encoder(pk.default_vocabulary()).ids(text).tolist() == ids(text)[:-1]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "x" * 30_000, "\x85 \xa0 y", "日本語 ÉÈ", " " * 3000 + "."])
def test_ids_of_special_texts(text):
    assert pk.encoder(pk.default_vocabulary()).ids(text).tolist() == ids(text)[:-1]


def check(packed, docs, window):
    rows = sorted((tuple(r) for r in packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()), key=repr)
    want = []
    for doc, text in docs:
        own = ids(text)
        want += [(doc, s, len(own[s : s + window]), zlib.crc32(np.array(own[s : s + window], "<u4").tobytes()), len(own)) for s in range(0, len(own), window)]
    assert sorted((r[:5] for r in rows), key=repr) == sorted(want, key=repr)
    fill = {}
    for r in rows:
        fill.setdefault(r[5], []).append((r[6], r[2]))
    for parts in fill.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= window
    used, _ = sequential([r[2] for r in rows if r[2] < window], window)
    assert len(fill) == used + sum(r[2] == window for r in rows)


def test_corpus(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    check(pk.pack(pk.pieces(table)), [(r.doc_id, r.text) for r in table.collect()], 2048)


def test_many_salts(spark, sf, monkeypatch):
    monkeypatch.setattr(pk, "SALT_ROWS", 5)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    check(pk.pack(pk.pieces(table, window=128), 128), [(r.doc_id, r.text) for r in table.collect()], 128)


def test_odd_rows(spark):
    check(pk.pack(pk.pieces(odd(spark))), ODD, 2048)


def test_empty_table(spark):
    assert pk.pack(pk.pieces(empty(spark))).count() == 0


def test_exact_multiples_of_the_window(spark):
    text = " the" * 7  # 7 ids and the closing one
    docs = [(1, text), (2, text), (3, text + text[4:] + " the")]
    check(pk.pack(pk.pieces(documents(spark, docs), window=8), 8), docs, 8)


def test_padded_sequences(spark):
    docs = documents(spark, [(1, " the" * 10), (2, " the" * 4), (3, " the" * 6)])
    packed = pk.pack(pk.pieces(docs, window=16, with_ids=True), 16)
    got = {r.sequence_id: r.ids for r in pk.padded_sequences(packed, 16).collect()}
    # 11 + 5 ids fill a window; 7 ids are padded to 16.
    assert sorted(len(x) for x in got.values()) == [16, 16]
    assert sum(len([i for i in x if i]) for x in got.values()) == 23
    short = pk.padded_sequences(pk.pack(pk.pieces(documents(spark, [(1, " the" * 7)]), window=16, with_ids=True), 16), 16).first()
    assert len(short.ids) == 8

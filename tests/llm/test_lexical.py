import re
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from articlelake.llm import lexical_search as ls

from .helpers import LONG, documents, empty

KIND = "item_id long, text string, rank int, doc_id string"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], KIND)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, asked, top=10):
    """Every document scored for every item, in whole numbers."""
    held = [(i, words(t)) for i, t in docs if words(t)]
    n, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in asked:
        scored = []
        for i, w in held:
            tf, m = Counter(w), 25 + (75 * len(w) * n) // total
            weight = {t: int(np.floor(1000 * np.log((2 * n + 2) / (2 * df[t] + 1)))) for t in tf}
            score = sum(weight[t] * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in words(text) if t in tf)
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@given(st.text())
def test_terms(text):
    assert [t.decode() for t in ls.terms_of(text.encode("utf-8", "ignore"))] == words(text.encode("utf-8", "ignore").decode())


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "...!!!"), (4, "Alpha BETA beta"), (4, "Alpha BETA beta"), (5, "alpha"), (None, "alpha"), (6, LONG), (7, "日本 É beta"), (8, "Éclair é É"), (9, "gamma\0delta"), (10, "und")]
    asked = [(1, "alpha beta beta"), (1, "alpha"), (2, None), (3, ""), (4, "nowhere"), (None, "É und"), (5, "日本 delta")]
    assert result(ls.search(documents(spark, docs), items(spark, asked))) == brute(docs, asked)


def test_empty_tables(spark):
    assert ls.search(empty(spark), items(spark, [(1, "a")])).count() == 0
    for none in ([], [(1, None)]):
        assert ls.search(documents(spark, [(1, "a")]), items(spark, none)).columns == ["item_id", "rank", "doc_id", "score"]
        assert ls.search(documents(spark, [(1, "a")]), items(spark, none)).count() == 0


def test_many_blocks_and_shards(spark, monkeypatch):
    """Small blocks and shards, items in several blocks: bounds skip documents, results stay whole."""
    monkeypatch.setattr(ls, "BLOCK_DOCS", 4)
    monkeypatch.setattr(ls, "CELLS", 1)
    monkeypatch.setattr(ls, "ITEM_TERMS", 40)
    rng = np.random.default_rng(5)
    terms = [f"w{k}" for k in range(120)]
    topics = [rng.choice(120, 25) for _ in range(12)]
    docs = [(k, " ".join(terms[t] for t in rng.choice(topics[k % 12], rng.integers(1, 60)))) for k in range(900)]
    asked = [(k, " ".join(terms[t] for t in rng.choice(topics[k % 12], 6))) for k in range(30)]
    assert result(ls.search(documents(spark, docs), items(spark, asked))) == brute(docs, asked)


def test_blocks_are_skipped():
    """A shard of clustered documents: bounds hold for every document, and some blocks are never scored."""
    rng = np.random.default_rng(2)
    docs, width = 600, 60
    topic = np.arange(docs) % 6
    chosen = [np.unique(rng.choice(10, 6) + 10 * t) for t in topic]
    ends = np.concatenate(([0], np.cumsum([len(c) for c in chosen])))
    shard = ls.Shard(np.full(docs, 20), ends, np.concatenate(chosen), rng.integers(1, 9, ends[-1]), width, docs, 20 * docs)
    for term in range(width):
        rows, block, summary = shard.blocks(term)
        assert sorted(rows) == [d for d in range(docs) if term in chosen[d]]
        for b in range(len(summary)):
            assert (summary[b] == shard.whole[rows[block == b]].max(0)).all()


def test_corpus_equals_scoring_everything(spark, sf):
    docs, asked = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = lambda df, i: [(r[i], r.text) for r in df.collect()]
    assert result(ls.search(docs, asked)) == brute(pairs(docs, "doc_id"), pairs(asked, "item_id"))

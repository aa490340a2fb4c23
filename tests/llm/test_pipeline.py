import numpy as np

import corpus_pipeline as cp
from articlelake.llm import quality, toxicity

from .helpers import documents, empty, odd
from .test_simhash import groups, plain


def test_stages_take_effect(spark, sf):
    """Each stage against its own operator, over all its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = [name for name, _ in cp.STAGES]
    assert names == ["quality", "toxicity", "near-dedup", "packing"]
    kept = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, labels)
    first = cp.keep_quality(spark, docs, sf)
    assert first.columns == docs.columns
    want = {i for i, t in kept.items() if model.scores([t.encode()])[0] >= 0.7}
    assert {r.doc_id for r in first.collect()} == want and 0 < len(want) < len(kept)
    judge = toxicity.fit(docs, labels)
    second = cp.keep_clean(spark, first, sf)
    want = {i for i in want if judge.probability(kept[i]) < 0.5}
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == want
    third = cp.keep_distinct(spark, second, sf)
    ids = sorted(want)
    prints = np.array([plain(kept[i]) for i in ids], np.uint64)
    want = {i for i, low in zip(ids, groups(prints, ids)) if i == low}  # all pairs of fingerprints
    assert third.columns == docs.columns and {r.doc_id for r in third.collect()} == want
    last = cp.pack(spark, third, sf)
    assert {r.doc_id for r in last.collect()} == want
    run = cp.run(spark, sf)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in last.collect())


def test_odd_rows(spark, sf):
    """Every stage keeps rows of its input as they are, and the last covers each once, whatever the ids."""
    for frame in (odd(spark), empty(spark)):
        docs = frame
        for name, stage in cp.STAGES[:3]:
            before = sorted(map(tuple, docs.collect()), key=repr)
            docs = stage(spark, docs, sf)
            after = sorted(map(tuple, docs.collect()), key=repr)
            assert docs.columns == frame.columns and all(after.count(r) <= before.count(r) for r in after), name
        pieces = cp.pack(spark, docs, sf).collect()
        whole = [r for r in pieces if r.start == 0]
        assert sorted((r.doc_id for r in whole), key=repr) == sorted((r.doc_id for r in docs.collect()), key=repr)
        assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in whole)


def test_one_row_of_each_group_stays(spark, sf):
    """Also of rows that share the smallest id, or have none."""
    kept = cp.keep_distinct(spark, odd(spark), sf)
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    # 1, 2 and 3 have no words; 6 comes twice, 7 repeats it; one row has no id.
    assert ids == sorted([1, 4, 5, 6, 8, None], key=repr) and kept.columns == odd(spark).columns
    rows = [(None, "a b c d e"), (None, "a b c d e"), (3, "f g h i j"), (3, "f g h i j"), (None, "f g h i j"), (2, "k l m n o"), (2, "p q r s t")]
    kept = sorted(((r.doc_id, r.text) for r in cp.keep_distinct(spark, documents(spark, rows), sf).collect()), key=repr)
    assert kept == sorted([(None, "a b c d e"), (3, "f g h i j"), (2, "k l m n o"), (2, "p q r s t")], key=repr)

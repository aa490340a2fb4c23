import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from articlelake.llm import sentencepiece_fst as fst

from .helpers import ODD, empty, odd

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=fst.default_model())
TEXTS = [
    "", "a", " ", "   x  y", "▁a", "\n\t ", "日本語テキスト梦", "😀 smile", "é ñ ß", "a" * 500, "<s> <0x0A> <unk>", "aaa aaaaaa",
    "0123 4567.89", "\u0000x", *(" " * k + "x" + " " * k for k in range(1, 20)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_texts_equal_the_library(text):
    model = fst.transducer()
    assert model.encode(text).tolist() == LIBRARY.encode(text)
    assert model.decode(model.encode(text)) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdethng  ▁\n.,'é日😀0"), max_size=60) | st.text(max_size=30))
def test_any_text_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert fst.transducer().encode(text).tolist() == LIBRARY.encode(text)


def test_corpus_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = docs.select("doc_id", fst.encode_column(docs.text).alias("ids"))
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: LIBRARY.encode(t) for i, t in texts.items()}
    back = ids.select("doc_id", fst.decode_column(ids.ids).alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == texts
    assert all(r.exact for r in fst.round_trip(docs).collect())


def test_path_is_the_shortest_of_all(monkeypatch):
    """In a unigram model every way to cut a text is weighed; the path must be the lightest."""
    model = fst.Transducer(fst.default_model())
    model.kind = fst.UNIGRAM
    rng = random.Random(4)
    model.scores = {p: -rng.random() * 9 for p in ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb"]}

    def lightest(text):
        return min((-model.scores[text[:k]] + lightest(text[k:]) for k in range(1, len(text) + 1) if text[:k] in model.scores), default=0.0) if text else 0.0

    for _ in range(60):
        text = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        assert np.isclose(sum(-model.scores[p] for p in model.path(text)), lightest(text))


def test_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(fst, "KEPT", 50)
    monkeypatch.setattr(fst, "KEPT_PAIRS", 50)
    model = fst.Transducer(fst.default_model())
    text = " ".join(f"w{i}rd{i * 7}s" for i in range(500))
    assert model.encode(text).tolist() == LIBRARY.encode(text)
    assert len(model.paths) + len(model.older) <= 50 and len(model.pairs) <= 50


def test_odd_rows(spark):
    got = fst.round_trip(odd(spark)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and all(r.exact for r in got)
    assert by[1].n_ids == by[2].n_ids == 0 and by[5].n_ids == len(LIBRARY.encode(dict(ODD)[5]))
    assert by[6].ids_crc32 == by[7].ids_crc32
    assert fst.round_trip(empty(spark)).count() == 0


def test_null_ids_decode_to_null(spark):
    frame = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in frame.select(fst.decode_column(frame.ids)).collect()] == [None, ""]

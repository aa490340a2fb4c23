import numpy as np

from articlelake.llm import language

from .helpers import empty, held_out, odd


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    model = language.fit(docs)
    got = held_out(language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id"), 5, 0)
    hits = [r.lang == r.lang_pred for r in got.collect()]
    assert len(hits) > 100 and np.mean(hits) >= 0.97


def small():
    return language.train([("der die das und nicht " * 9, "de"), ("the and of with that " * 9, "en")] * 20, epochs=20)


def test_all_windows_count():
    """A text is judged by all its windows, not by its beginning."""
    model = small()
    english, german = b"the and of with that " * 40, b"der die das und nicht " * 400
    names, scores = model.predict([german, english, english + german, german + english])
    assert names == ["de", "en", "de", "de"] and all(0.5 <= s <= 1 for s in scores)


def test_batches_do_not_matter():
    model = small()
    texts = [b"the and of " * n for n in range(1, 60)] + [b"der die das " * 30_000, b""]
    together = model.predict(texts)
    alone = [model.predict([t]) for t in texts]
    assert together[0] == [n[0] for n, _ in alone]
    assert np.allclose(together[1], [s[0] for _, s in alone], atol=1e-5)


def test_tables_equal_plain_convolution():
    model = small()
    data, _, _ = language.windows([b"the quick brown fox " * 30])
    want = []
    for w in language.WIDTHS:
        k = model.kernels[w]
        want.append(sum(k[j][data[:, j : language.WINDOW - w + 1 + j]] for j in range(w)).max(1))
    assert np.allclose(model.pooled(data, model.tables()), np.concatenate(want, 1) + model.bias, atol=1e-5)


def test_odd_rows(spark):
    got = language.identify(odd(spark), small()).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 4))
    assert by[5].lang_pred == "de" and {r.lang_pred for r in got if r.doc_id == 6} == {by[7].lang_pred}


def test_empty_table_and_nothing_to_learn(spark):
    model = language.fit(empty(spark))
    assert model.languages == []
    assert language.identify(empty(spark), model).count() == 0
    assert {r.lang_pred for r in language.identify(odd(spark), model).collect()} == {"und"}


def test_null_languages_are_not_learned(spark):
    assert language.sample(odd(spark)) == []

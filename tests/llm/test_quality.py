import numpy as np

from articlelake.llm import quality

from .helpers import LONG, empty, held_out, labelled, odd


def test_held_out_rows(spark, sf):
    docs, labels = labelled(spark, sf.replace("0.001", "0.01"))
    scored = quality.score_quality(docs, quality.fit(docs, labels)).join(labels, "doc_id")
    rows = held_out(scored, 4, 2).collect()
    good, bad = ([r.predicted for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 5 and np.mean(good) >= 0.97 and np.mean(bad) <= 0.15


def small():
    return quality.train([("A calm line of words here.", 1), ("%%% $$$ &&& %%% $$$", 0)] * 40, epochs=8)


def test_scores_equal_plain_averages():
    """The vectorised pass equals averaging every feature of a text, one by one."""
    model = small()
    for text in (b"A calm %%% line line", b"x", b"two  words\nand words words"):
        data = np.frombuffer(b" " + text + b" ", np.uint8)
        _, bucket, weight = quality.features(data, np.zeros(1, int))
        logit = (model.value[bucket] * weight).sum() / max(weight.sum(), 1) + model.bias
        assert np.isclose(model.scores([text])[0], 1 / (1 + np.exp(-logit)), atol=1e-6)


def test_features_are_words_markers_and_grams():
    data = np.frombuffer(b" ab ab ", np.uint8)
    at, bucket, weight = quality.features(data, np.zeros(1, int))
    assert (bucket == quality.REPEAT).sum() == 1 and (bucket == quality.FRESH).sum() == 1
    # A word of two letters: three 2-grams, two 3-grams, one 4-gram; and the word itself.
    assert (weight == 1).sum() == 12 and (weight == quality.WORD_WEIGHT).sum() == 4
    words = bucket[(weight == quality.WORD_WEIGHT) & (bucket < quality.BUCKETS)]
    assert words[0] == words[1]


def test_neighbours_in_a_batch_do_not_matter():
    model = small()
    texts = [b"calm line", None, b"", b"calm line", b"%%% " * 5, LONG.encode(), b"word"]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts], atol=1e-9)


def test_whole_text_counts():
    model = small()
    tail = b"%%% $$$ &&& " * 300_000
    assert model.scores([b"A calm line of words here. " * 10 + tail])[0] < 0.2


def test_odd_rows(spark):
    got = quality.score_quality(odd(spark), small()).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 10 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert by[1] == by[2] and by[6] == by[7]


def test_nothing_to_learn(spark, sf):
    _, labels = labelled(spark, sf)
    model = quality.fit(empty(spark), labels)
    assert model.scores([b"x"])[0] == 0.5
    assert quality.score_quality(empty(spark), model).count() == 0
    one = quality.train([("a", 1), ("b", 1)])
    assert one.scores([b"x"])[0] == 0.75

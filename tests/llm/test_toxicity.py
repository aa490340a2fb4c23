import math
import random

import numpy as np

from articlelake.llm import toxicity

from .helpers import LONG, empty, held_out, labelled, odd


def brute_segments(scores):
    """All maximal segments by their definition: split recursively at the best segment."""
    out = []

    def split(low, high):
        best = max(
            ((sum(scores[a:b]), -(b - a), -a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,)
        )
        if best[0] <= 0:
            return
        a, b = -best[2], best[3]
        out.append((a, b - 1, best[0]))
        split(low, a)
        split(b, high)

    split(0, len(scores))
    return sorted(out)


def test_segments_equal_recursive_maxima():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-1.0, -1.0, -1.0, 1.5, 2.25, 3.125]) for _ in range(rng.randint(1, 24))]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(hits, 1.0)
        want = brute_segments(scores)
        assert math.isclose(sum(s for *_, s in got), sum(s for *_, s in want))
        assert sorted(round(s, 9) for *_, s in got) == sorted(round(s, 9) for *_, s in want)
        assert all(math.isclose(sum(scores[a : b + 1]), s) for a, b, s in got)


class Counted(float):
    """A sum that counts its comparisons."""

    seen = 0

    def __ge__(self, other):
        Counted.seen += 1
        return float(self) >= float(other)


for _name in ("__add__", "__radd__", "__sub__", "__rsub__", "__mul__", "__rmul__"):
    setattr(Counted, _name, lambda self, other, f=getattr(float, _name): Counted(f(self, float(other))))


def test_segments_take_linear_time():
    """Texts that drift down, or down and up again, need a few comparisons a hit."""
    n = 3000
    falling = [(10 * i, 1.0) for i in range(n)]
    waves = [(10 * i if i < n // 2 else 5 * n + 2 * i, 1.5) for i in range(n)]
    valley = [(3 * i - i * (i % 7 == 0), 2.5) for i in range(n)]
    for hits in (falling, waves, sorted(dict(valley).items())):
        Counted.seen = 0
        found = toxicity.segments(hits, Counted(1.0))
        assert found and Counted.seen <= 5 * n


def test_background_rate_solves_its_equation():
    scores, shares = np.array([3.0, 1.0, -0.2]), np.array([0.001, 0.01, 0.989])
    rate = toxicity.background_rate(scores, shares)
    assert rate > 0 and math.isclose((shares * np.exp(rate * scores)).sum(), 1, abs_tol=1e-6)


def test_held_out_rows(spark, sf):
    docs, labels = labelled(spark, sf.replace("0.001", "0.1"))
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).join(labels, "doc_id")
    rows = held_out(scored, 5, 0).collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert len(toxic) > 50 and np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02


def small():
    counts = [("scum", 40, 0), ("moron", 30, 1), ("the", 90, 500), ("morons", 3, 0), ("moro*", 33, 1)]
    model = toxicity.build(counts, 400, 3000)
    return toxicity.ToxicityModel(model.words, model.cost, model.rate, model.constant, (1.0, 0.5, -2.0), model.heads)


def test_passage_is_found_wherever_it_stands():
    model = small()
    text = "the " * 5000 + "you Scum, moron scum" + " the" * 5000
    words, found = model.passages(text)
    assert words == 10_004 and [(a, b) for a, b, _ in found] == [(5001, 5003)]
    assert model.probability(text) > model.probability("the " * 10_000)


def test_prefix_stands_in_for_unknown_words():
    assert small().score_of("moronic") == small().words["moro*"]
    assert small().score_of("more") is None


def test_odd_rows(spark):
    got = toxicity.score_toxicity(odd(spark), small()).collect()
    assert len(got) == 10 and len({r.score for r in got}) == 1 and {r.predicted for r in got} == {0}


def test_nothing_to_learn(spark, sf):
    _, labels = labelled(spark, sf)
    model = toxicity.fit(empty(spark), labels)
    assert model.words == {} and 0 < model.probability("scum") < 1
    assert toxicity.score_toxicity(empty(spark), model).count() == 0


def test_passages_column(spark):
    row = odd(spark).where("doc_id = 5").select(small().passages_of("text").alias("p")).first()
    assert row.p == [] and LONG


def test_token_counts(spark):
    rows = [("Scum scum here", 1, True), ("Scummiest", 1, True), ("here", 0, True), (None, 0, True)]
    counted = toxicity.token_counts(spark.createDataFrame(rows, "text string, _label int, half boolean"))
    got = {r.token: (r.toxic, r.clean) for r in counted.collect()}
    assert got == {"scum": (1, 0), "here": (1, 1), "scummiest": (1, 0), "scummi*": (1, 0), "scumm*": (1, 0), "scum*": (1, 0)}

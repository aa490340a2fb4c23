import re

from articlelake.llm import license_scan as ls

from .helpers import LONG, documents, empty, odd

NOTE = "Released under the MIT License."


def brute(text):
    low = (text or "").translate(str.maketrans(ls._UPPER, ls._LOWER))
    words = re.findall(ls.WORD, low)
    places, labels, best = [], set(), 0.0
    for t in ls.templates():
        for i in range(len(words) - len(t.key) + 1):
            if words[i : i + len(t.key)] == t.key:
                at = i - t.start
                same = sum(0 <= at + j < len(words) and words[at + j] == w for j, w in enumerate(t.words))
                best = max(best, same / len(t.words))
                labels.add(t.label)
                if any(t.label == b and t.key == p.split() for p, b in ls.BASE):
                    places.append((i, t.label))
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted({b for _, b in places})), ",".join(sorted(labels)), best)


TEXTS = [
    NOTE, NOTE * 3, "under the mit licenses", "the mit license", "Licensed under the Apache License, Version 2.0", "CC-BY-NC", "cc by nc cc by nc cc BY-NC 4",
    "Apache License Version", "x " * 50 + "GNU General Public License, version 3", "under under the mit license the mit license", "ÉCC BY NC", "cc by ncé",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal",
    "mit " * 2000 + NOTE, None, "", "....",
]


def test_places_labels_and_scores_equal_brute_force(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    got = {r[0]: tuple(r)[1:] for r in ls.report(ls.scan(docs)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_frequent_phrase_words_do_not_hide_a_phrase(spark):
    """All words of the phrase in every document: the rarest word is no rarer than others."""
    docs = documents(spark, [(i, "cc by nc") for i in range(30)] + [(99, "by cc nc")])
    assert {r.n_base for r in ls.report(ls.scan(docs)).where("doc_id < 99").collect()} == {1}


def test_odd_rows(spark):
    got = ls.report(ls.scan(odd(spark))).collect()
    assert len(got) == 10 and all(r.n_base == 0 and r.labels == "" and r.score == 0 and r.first_word is None for r in got)
    assert {r.doc_id: r.n_words for r in got}[5] == len(LONG.split())


def test_empty_table(spark):
    assert ls.report(ls.scan(empty(spark))).count() == 0

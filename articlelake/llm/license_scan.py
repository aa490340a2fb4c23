"""License scan: positional rare-token index over licence templates.

Every template is a list of words with one mandatory key phrase. The index holds, for each key
phrase, its rarest word by inverse document frequency over the whole corpus (the word with the
highest IDF) with its position, and the positions of all other words. A file's occurrences of
indexed words are looked up; each gives the place where the phrase would start, the second-rarest
word must stand at its own relative position, and the phrase is then verified word by word. As
every place of a phrase holds its rarest word, none is missed, whatever the frequencies are.
Around a verified phrase the rest of the template is compared at the same relative positions,
which gives the score.

All steps are array functions on the row: after the frequency pass there is no join and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (label, template, first word of the key phrase, words of it). Words as `words_of` gives them.
# Licence texts are quoted as published; labels follow SPDX names in lower case.
TEMPLATES = [
    ("mit", "released under the mit license", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "you may not use this file except in compliance with the license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial 4"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "this program is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the bsd license", "under the bsd license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2"),
    ("bsl-1", "distributed under the boost software license version 1 0", "boost software license version 1"),
]

# Phrases whose every place counts as a base place, and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]
    start: int  # of the key phrase
    key: list[str]


def templates(rows=None) -> list[Template]:
    out = []
    for label, text, phrase in rows or TEMPLATES:
        words, key = text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out.append(Template(label, words, start, key))
    return out


def words_of(text: Column) -> Column:
    """Words of a whole text, A-Z in lower case; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents of ``words(words)`` that hold each word of the vocabulary (a fixed, small set)."""
    held = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    rows = words.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    return {r.w: r.n for r in rows}


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _index(items: list[Template], df: dict[str, int]) -> Column:
    """Array of postings: one per key phrase, with its rarest two words and their positions in it."""
    rows = []
    for n, t in enumerate(items):
        rarest = sorted(range(len(t.key)), key=lambda i: (df.get(t.key[i], 0), i))
        first, second = rarest[0], rarest[1 if len(rarest) > 1 else 0]
        rows.append(
            F.struct(
                F.lit(n).alias("t"), F.lit(t.label).alias("label"), F.lit(t.key[first]).alias("rare"), F.lit(first).alias("at"),
                F.lit(t.key[second]).alias("next"), F.lit(second).alias("next_at"), _strings(t.key).alias("key"),
                F.lit(t.start).alias("start"), _strings(t.words).alias("words"),
                F.lit(any(t.label == b and t.key == p.split() for p, b in BASE)).alias("base"),
            )
        )
    return F.array(*rows)


def scan(docs: DataFrame, rows=None) -> DataFrame:
    """doc_id, n_words, matches of every row of ``docs(doc_id, text)``.

    matches: array of (label, first_word, n_words, base, share), one per place of a key phrase, in
    order of place and template; ``share`` is the part of the template's words found at their
    relative positions. Null and empty texts have no words and no match. Repeated rows give
    repeated results; other columns are ignored. The texts are read twice (frequencies, scan).
    """
    items = templates(rows)
    worded = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    vocabulary = sorted({w for t in items for w in t.key})
    df = frequencies(worded, vocabulary)
    index = _index(items, df)
    anchors = sorted({min(t.key, key=lambda w: (df.get(w, 0), t.key.index(w))) for t in items})

    # Files without any anchor word are done; the others get their anchors' positions.
    hit = F.exists("words", lambda w: w.isin(anchors))
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull())
    word_at = lambda i: F.get("words", i)
    starts = lambda i: F.transform(
        F.filter("index", lambda p: (p.rare == word_at(i)) & (word_at(i - p["at"] + p.next_at) == p.next)),
        lambda p: F.struct((i - p["at"]).alias("first"), p.alias("p")),
    )
    verified = lambda c: (c["first"] >= 0) & (F.slice("words", c["first"] + 1, F.size(c["p"]["key"])) == c["p"]["key"])
    found = F.filter(F.flatten(F.transform("places", starts)), verified)

    def share(c: Column) -> Column:
        same = F.filter(c["p"]["words"], lambda w, j: word_at(c["first"] - c["p"]["start"] + j) == w)
        return F.size(same) / F.size(c["p"]["words"])

    match = F.transform(
        "found",
        lambda c: F.struct(
            c["first"].cast("long").alias("first_word"), c["p"]["t"].alias("template"), c["p"]["label"].alias("label"),
            F.size(c["p"]["key"]).alias("n_words"), c["p"]["base"].alias("base"), share(c).alias("share"),
        ),
    )
    kept = worded.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(hit, F.col("words")).alias("words"))
    placed = kept.select("doc_id", "n_words", "words", F.when(F.col("words").isNotNull(), places).alias("places"))
    listed = placed.withColumn("index", F.when(F.col("words").isNotNull(), index)).select("doc_id", "n_words", "words", found.alias("found"))
    return listed.select("doc_id", "n_words", F.coalesce(F.sort_array(match), F.expr("cast(array() as array<struct<first_word:bigint,template:int,label:string,n_words:int,base:boolean,share:double>>)")).alias("matches"))


def report(scanned: DataFrame) -> DataFrame:
    """One row per document: counts and places of base phrases, labels, and the best share as score.

    Without a match the labels are empty strings, the places null and the score 0.
    """
    base = F.filter("matches", lambda m: m.base)
    labels = lambda matches: F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m.label))), ",")
    firsts = F.transform(base, lambda m: m.first_word)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.share)), F.lit(0.0)).alias("score"),
    )


def oracle_sql() -> str:
    """DuckDB: every key phrase at every place, without an index."""
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(
        f"({n}, '{t.label}', {quote(t.words)}, {quote(t.key)}, {t.start}, {str(any(t.label == b and t.key == p.split() for p, b in BASE)).lower()})"
        for n, t in enumerate(templates())
    )
    return f"""
with worded as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from documents),
template(t, label, twords, key, start, base) as (values {rows}),
place as (
  select r, t, label, base, twords, start, words, unnest(list_filter(range(0, len(words) - len(key) + 1), lambda i: words[i + 1 : i + len(key)] = key)) as first
  from worded join template on list_has_all(words, key)),
scored as (
  select *, len(list_filter(range(0, len(twords)), lambda j: first - start + j >= 0 and words[first - start + j + 1] = twords[j + 1])) / len(twords) as share from place)
select doc_id, len(words)::bigint as n_words,
  count(first) filter (where base) as n_base,
  min(first) filter (where base) as first_word,
  max(first) filter (where base) as last_word,
  coalesce(array_to_string(list_sort(list(distinct label) filter (where base)), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list(distinct label) filter (where label is not null)), ','), '') as labels,
  coalesce(max(share), 0.0)::double as score
from worded left join (select r, label, base, first, share from scored) using (r)
group by r, doc_id, words"""

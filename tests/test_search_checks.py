import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from articlelake.functions.chunks import full_text, overflow_rows, split_overflow, text_chunks
from articlelake.operators import checks
from articlelake.functions.folding import fold_title
from articlelake.operators.search import by_title, like_pattern, search_title_words, search_titles, search_titles_loosely

ARTICLES = [
    (1, "Paris", None, "city"),
    (2, "Paris (Texas)", None, "town"),
    (3, "Paname", "Paris", None),
    (4, "Parisien", "Missing", "own"),
    (5, "Par_x", "Bare", "kept"),
    (6, "Bare", None, None),
    (7, "100% Paris", None, "pct"),
    (8, "Élan", None, "accent"),
]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(
        [(*a, a[1]) for a in ARTICLES], "id bigint, title string, redirect string, description string, title_srch string"
    ).withColumn("title_srch", fold_title(F.col("title"))).cache()


def rows(df):
    return [tuple(r) for r in df.select("sub_title", "id", "title", "description").collect()]


@pytest.mark.parametrize("limit", [None, 10, 200_000])
def test_prefix_search_resolves_one_hop(articles, limit):
    assert sorted(rows(search_titles(articles, "Pa", limit))) == [
        ("Paname", 1, "Paris", "city"),
        ("Par_x", 6, "Bare", "kept"),
        ("Paris", 1, "Paris", "city"),
        ("Paris (Texas)", 2, "Paris (Texas)", "town"),
        ("Parisien", 4, "Parisien", "own"),
    ]


def test_limit_is_in_title_order(articles):
    assert [r[0] for r in rows(search_titles(articles, "Pa", 2))] == ["Paname", "Par_x"]


def test_wildcards(articles):
    assert [r[0] for r in rows(search_titles(articles, "%xas%", 9))] == ["Paris (Texas)"]
    assert [r[0] for r in rows(search_titles(articles, "P_ris", 9))] == ["Paris", "Paris (Texas)", "Parisien"]
    assert [r[0] for r in rows(search_titles(articles, r"Par\_", 9))] == ["Par_x"]
    assert [r[0] for r in rows(search_titles(articles, r"100\%%", 9))] == ["100% Paris"]
    assert rows(search_titles(articles, "", 9)) == []
    assert rows(search_titles(articles, "paris", 9)) == []


def test_like_pattern():
    assert like_pattern("ab") == "ab%"
    assert like_pattern("a%b") == "a%b"
    assert like_pattern(r"a\b") == "ab%"
    assert like_pattern(r"a\\b") == r"a\\b%"


def test_prefix_reaches_the_scan(spark, articles, tmp_path):
    path = str(tmp_path / "a")
    by_title(articles).write.parquet(path)
    plan = search_titles(spark.read.parquet(path), "Pa", 5)._jdf.queryExecution().toString()
    assert "StringStartsWith(title,Pa)" in plan
    assert "Exchange hashpartitioning(title" not in plan


def test_folded_titles(spark):
    titles = ["Élan", "ELAN", "Ñandú", "Straße", "e\u0301lan", "Ω mega", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(fold_title(F.col("t"))).collect()]
    assert got == ["elan", "elan", "nandu", "strasse", "elan", "ω mega", "", None]


# Letters whose folding and collation differ: rare forms that no rule of the tables gives.
RARE = {"ﾞ", "ﾟ", "ᵌ", "ⵯ", "ꜳ", "Ꜳ", "𐞀", "ɜ", "Ɜ", "ᴈ", "ʩ", "𝼀", "ᴉ", "ᵎ", "ƾ", "ʦ", "ŀ", "Ŀ", "ͺ"}
SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "GEORGIAN", "HEBREW", "FULLWIDTH", "HALFWIDTH", "HIRAGANA", "KATAKANA", "CHEROKEE", "COPTIC", "GLAGOLITIC")


def test_folding_agrees_with_the_collation_on_every_letter(spark):
    """Letters of all scripts are never folded into one that the collation tells apart; letters of the scripts
    above, where it finds them alike, are folded alike."""
    import unicodedata

    letters = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c))[0] == "L" and chr(c) not in RARE]
    df = spark.createDataFrame([(c,) for c in letters], "c string").withColumn("f", fold_title(F.col("c")))
    wrong = df.where(F.collate("c", "UNICODE_CI_AI") != F.collate("f", "UNICODE_CI_AI")).collect()
    assert [(r.c, r.f) for r in wrong] == []
    own = df.where(F.col("c").isin([c for c in letters if unicodedata.name(c, "?").split()[0] in SCRIPTS]))
    apart = own.groupBy(F.collate("c", "UNICODE_CI_AI")).agg(F.collect_set("f").alias("f")).where("size(f) > 1").collect()
    assert [r.f for r in apart] == []


def test_accents_written_apart(spark):
    """Composed and decomposed titles are folded alike; vowel signs of other scripts are no accents."""
    import unicodedata

    titles = ["Ångström", "Đỗ Mười", "Ёлка йод", "أحمد", "हिन्दी", "ไทย", "Ναΐς", "İzmir"]
    pairs = [(t, unicodedata.normalize("NFD", t)) for t in titles]
    got = spark.createDataFrame(pairs, "a string, b string").select(fold_title(F.col("a")), fold_title(F.col("b"))).collect()
    assert all(a == b for a, b in got) and [a for a, _ in got] == ["angstrom", "do muoi", "елка йод", "أحمد", "हिन्दी", "ไทย", "ναισ", "izmir"]


def test_loose_prefix_reaches_the_scan(spark, articles, tmp_path):
    path = str(tmp_path / "b")
    by_title(articles).write.parquet(path)
    plan = search_titles_loosely(spark.read.parquet(path), "ÉLa")._jdf.queryExecution().toString()
    assert "StringStartsWith(title_srch,ela)" in plan


def test_loose_and_word_search(articles):
    assert [r.id for r in search_titles_loosely(articles, "elA").collect()] == [8]
    assert search_titles_loosely(articles, "").count() == 0
    assert sorted(r.id for r in search_title_words(articles, "paris TEXAS").collect()) == [2]
    assert search_title_words(articles, "?!").count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5), st.integers(1, 9))
def test_chunks_join_to_the_text(spark, texts, size):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", text_chunks(F.col("t"), size).alias("c")).orderBy("i").collect()
    for r, t in zip(got, texts):
        assert "".join(r.c) == t
        assert all(len(c) == size for c in r.c[:-1]) and (len(r.c[-1]) > 0 or t == "")


def test_null_text_is_one_empty_chunk(spark):
    assert spark.sql("select cast(null as string) t").select(text_chunks(F.col("t"))).first()[0] == [""]


def test_full_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(150_000))
    df = spark.createDataFrame([(1, 0, text), (1, 1, "short")], "article_id int, section_id int, text string")
    split = split_overflow(df)
    ext = overflow_rows(split, ["article_id", "section_id"])
    assert ext.count() == 10
    got = {r.section_id: r.text for r in full_text(split.drop("overflow"), ext).collect()}
    assert got == {0: text, 1: "short"}


def test_checks(spark):
    parent = spark.createDataFrame([(1, "abc"), (2, "toolong")], "id int, name string")
    child = spark.createDataFrame([(1,), (3,), (None,), (3,)], "ref int")
    assert [tuple(r) for r in checks.orphan_rows(child, parent, [("ref", "id")]).collect()] == [(3,), (3,)]
    assert {tuple(r) for r in checks.duplicate_keys(child, ["ref"]).collect()} == {(3, 2)}
    assert [tuple(r) for r in checks.length_violations(parent, {"name": 5}, ["id"]).collect()] == [(2, "name", 7, 5)]
    sections = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 2)], "article_id int, section_id int")
    assert {tuple(r) for r in checks.section_gaps(sections).collect()} == {(1, 2, True), (2, 2, False)}
    assert {tuple(r) for r in checks.table_counts({"p": parent, "c": child}).collect()} == {("p", 2), ("c", 4)}
    stored = spark.createDataFrame([(1, "x" * 501, "d" * 3)], "id int, display_text string, date_text string")
    assert checks.stored_length_violations("parsed_event", stored, ["id"]).first().column_name == "display_text"


def test_stored_detail_keeps_no_copy_beside_the_store(spark, sf, monkeypatch):
    from articlelake.plans import flows

    staged, stage = [], flows.stage
    monkeypatch.setattr(flows, "stage", lambda df, label: staged.append(label) or stage(df, label))
    assert flows.stored_detail(spark, sf).count() == 40
    assert staged == ["catalog"]


def test_stored_violations_scans_the_sections_once(spark, tmp_path):
    from articlelake.plans.flows import stored_violations

    tables = {
        "nation": ([(1, "PERU")], "n_nationkey int, n_name string"),
        "customer": ([(4, "Customer#000000004", 1, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": (
            [(k, 4, "O", "1-URGENT", "1995-03-04") for k in range(1, 9)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate string",
        ),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    found = stored_violations(spark, str(tmp_path))
    assert "regexp_replace(" not in found._jdf.queryExecution().analyzed().toString()
    counts = {(r.table_name, r.kind): r.n for r in found.collect()}
    assert counts["article_section", "repeated key"] == 1 and counts["article_section_format", "no parent"] == 1
    assert counts["parsed_event", "no parent"] == 0

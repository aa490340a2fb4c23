from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from articlelake.functions import calendar as cal
from articlelake.functions.mentions import HINT, find_mentions, with_mention_op
from articlelake.operators.events import scan_mentions
from articlelake.operators.dates import apply_op, resolve_dates

DAY = 86400


def seconds(y, m, d):
    return (date(y, m, d) - date(1970, 1, 1)).days * DAY


@given(st.dates())
def test_calendar_agrees_with_python(d):
    days = (d - date(1970, 1, 1)).days
    assert cal.civil_to_days(d.year, d.month, d.day) == days
    assert cal.days_to_civil(days) == (d.year, d.month, d.day)


@given(st.integers(-10**12, 10**12))
def test_calendar_round_trip_far_away(days):
    y, m, d = cal.days_to_civil(days)
    assert cal.civil_to_days(y, m, d) == days
    assert 1 <= d <= cal.month_length(y, m)


def test_native_calendar_agrees_with_the_fold(spark):
    years = [-13_000_000_000, -4713, -400, -1, 0, 1, 4, 100, 1600, 1900, 1970, 2000, 2024, 999_999]
    rows = [(y, m, d) for y in years for m, d in ((1, 1), (2, 28), (3, 1), (12, 31))]
    df = spark.createDataFrame(rows, "y bigint, m int, d int")
    got = df.select("y", "m", "d", cal.days_from_civil(F.col("y"), F.col("m"), F.col("d")).alias("n")).collect()
    assert all(r.n == cal.civil_to_days(r.y, r.m, r.d) for r in got)


def ops(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, date_text string")
    return [tuple(r._op) for r in with_mention_op(df).orderBy("i").collect()]


def test_absolute_forms(spark):
    def day(*a):
        return ("set", seconds(*a), seconds(*a) + DAY - 1, "day")

    got = ops(
        spark, "5 March 2001", "March 5, 2001", "2001-03-05", "March 2001", "2001", "1990s", "19th century",
        "21st century", "1 BC", "29 February 2000",
    )
    assert got == [
        day(2001, 3, 5), day(2001, 3, 5), day(2001, 3, 5),
        ("set", seconds(2001, 3, 1), seconds(2001, 4, 1) - 1, "month"),
        ("set", seconds(2001, 1, 1), seconds(2002, 1, 1) - 1, "year"),
        ("set", seconds(1990, 1, 1), seconds(2000, 1, 1) - 1, "decade"),
        ("set", seconds(1801, 1, 1), seconds(1901, 1, 1) - 1, "century"),
        ("set", seconds(2001, 1, 1), seconds(2101, 1, 1) - 1, "century"),
        ("set", cal.civil_to_days(0, 1, 1) * DAY, cal.civil_to_days(1, 1, 1) * DAY - 1, "year"),
        day(2000, 2, 29),
    ]


def test_dates_billions_of_years_away(spark):
    (op,) = ops(spark, "13000000000 BC")
    assert op[:2] == ("set", cal.civil_to_days(1 - 13_000_000_000, 1, 1) * DAY)


@pytest.mark.parametrize(
    "text",
    ["bad date", "30 February 2001", "29 February 2001", "0 BC", "0th century", "2001-13-01", "32 May", "24:00", "12:60", "9999", "0999", "199s", "", "M 2001"],
)
def test_failures(spark, text):
    assert ops(spark, text) == [("fail", None, None, None)]


def test_dependent_forms(spark):
    got = ops(spark, "31 January", "January 31", "29 February", "2 years later", "1 day earlier", "the following month",
              "The previous year", "the next day", "14:30")
    assert got == [
        ("fix", 1, 31, None), ("fix", 1, 31, None), ("fix", 2, 29, None), ("shift", 2, None, "year"),
        ("shift", -1, None, "day"), ("shift", 1, None, "month"), ("shift", -1, None, "year"), ("shift", 1, None, "day"),
        ("clock", 52200, None, None),
    ]


def test_fold_steps():
    ref = (seconds(2001, 1, 31), "day")
    assert apply_op(ref, "shift", 1, None, "month") == (seconds(2001, 2, 28), seconds(2001, 2, 28) + DAY - 1, "day")
    assert apply_op(ref, "fix", 2, 29, None) is None
    assert apply_op((seconds(2004, 1, 1), "year"), "fix", 2, 29, None)[0] == seconds(2004, 2, 29)
    assert apply_op((seconds(2001, 3, 1), "month"), "shift", 2, None, "year") == (seconds(2003, 3, 1), seconds(2003, 4, 1) - 1, "month")
    assert apply_op((seconds(1990, 1, 1), "decade"), "shift", 1, None, "day") == (seconds(1990, 1, 2), seconds(1990, 1, 3) - 1, "day")
    clock = apply_op(ref, "clock", 52200, None, None)
    assert clock == (ref[0] + 52200, ref[0] + 52259, "minute")
    assert apply_op((clock[0], "minute"), "shift", 1, None, "day")[0] == ref[0] + DAY + 52200
    assert apply_op(ref, "fail", None, None, None) is None


def test_chain_keeps_reference_after_failure_and_restarts_per_article(spark):
    events = spark.createDataFrame(
        [(1, 0, 0, "31 January 2001"), (1, 0, 9, "bad date"), (1, 1, 0, "the following month"), (2, 0, 0, "1 day later")],
        "article_id bigint, section_id int, start_pos int, date_text string",
    )
    as_of = datetime(2024, 1, 1)
    got = {(r.article_id, r.section_id, r.start_pos): (r.start_date, r.parse_status) for r in resolve_dates(events, as_of).collect()}
    assert got == {
        (1, 0, 0): (seconds(2001, 1, 31), 1), (1, 0, 9): (None, 2), (1, 1, 0): (seconds(2001, 2, 28), 1),
        (2, 0, 0): (seconds(2024, 1, 2), 1),
    }
    by_section = resolve_dates(events, as_of, chain=("article_id", "section_id"))
    assert by_section.where("section_id = 1").first().start_date == seconds(2024, 2, 1)


def test_chain_crosses_arrow_batches(spark):
    n = 25
    events = spark.range(n).selectExpr(
        "1L as article_id", "cast(id as int) as section_id", "0 as start_pos",
        "case when id = 0 then '1 May 2001' else '1 day later' end as date_text",
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        last = resolve_dates(events, datetime(2024, 1, 1)).agg(F.max("start_date")).first()[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert last == seconds(2001, 5, 1) + (n - 1) * DAY


def test_one_chain_over_many_partitions(spark):
    """A single article with all mentions; partitions start with failures and shifts."""
    import random

    rng = random.Random(7)
    texts = ["1 day later", "1 day later", "the following month", "bad date", "3 years earlier", "29 February"]
    rows = [(1, i, 0, rng.choice(texts) if rng.random() < 0.97 else f"{rng.randint(1, 28)} May {1900 + i % 100}") for i in range(600)]
    rows += [(2, 0, 0, "1 day later"), (3, 0, 0, "bad date"), (3, 1, 0, "1 day later")]
    events = spark.createDataFrame(rows, "article_id bigint, section_id int, start_pos int, date_text string")
    op_of = {r.date_text: tuple(r._op) for r in with_mention_op(events.select("date_text").distinct()).collect()}
    want, reference, last = {}, None, None
    for article, section, _, text in sorted(rows):
        if article != last:
            reference, last = (seconds(2024, 1, 1), "day"), article
        result = apply_op(reference, *op_of[text])
        reference = (result[0], result[2]) if result else reference
        want[article, section] = result[:2] if result else (None, None)
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "40")
    try:
        got = resolve_dates(events, datetime(2024, 1, 1)).collect()
    finally:
        spark.conf.unset(keys[0])
        spark.conf.set(keys[1], "4")
    assert {(r.article_id, r.section_id): (r.start_date, r.end_date) for r in got} == want
    assert len(got) == len(rows)


def found(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return [tuple(m)[:3] for m in df.select(find_mentions(F.col("t"))).first()[0]]


def test_mention_positions_are_code_points(spark):
    text = "\U0001d11e in 1999 and March 2001, then 5 BC\x011990s"
    hits = found(spark, text)
    assert [h[0] for h in hits] == ["1999", "March 2001", "5 BC", "1990s"]
    assert all(text[s:e] == t for t, s, e in hits)


def test_mentions_back_to_back_and_at_both_ends(spark):
    text = "1999 2000-01-02 14:30"
    assert [h[0] for h in found(spark, text)] == ["1999", "2000-01-02", "14:30"]
    assert found(spark, "no dates, K1999 or 12345") == []


def test_longest_form_wins(spark):
    text = "5 March 2001; March 5, 2001; March 5; 5 March; 10 years later; the previous day; 1990 BC; 3rd century; 2001-05"
    assert [h[0] for h in found(spark, text)] == [
        "5 March 2001", "March 5, 2001", "March 5", "5 March", "10 years later", "the previous day", "1990 BC",
        "3rd century", "2001",
    ]


def test_hint_is_a_superset_of_the_grammar(spark):
    from articlelake.operators.events import scan_mentions

    texts = ["The following year", "the next day", "in 1999", "May 5", "nothing", "ab"]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "article_id int, section_id int, text string")
    assert sorted(r.article_id for r in scan_mentions(df).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize(
    "text,mention,expected",
    [
        ("One. It was 1999. Two.", "1999", "It was 1999."),
        ("1999", "1999", "1999"),
        ("Began in 1999\nand went on! End", "1999", "Began in 1999\nand went on!"),
        ("Really? 5 BC", "5 BC", "5 BC"),
        ("v1.5 of 1999 shipped", "1999", "v1.5 of 1999 shipped"),
        ("\U0001d11e one.  \x01 two in 1999.", "1999", "\x01 two in 1999."),
        ("x" * 600 + " 1999", "1999", "x" * 600 + " 1999"),
    ],
)
def test_sentences(spark, text, mention, expected):
    df = spark.createDataFrame([(1, 0, text)], "article_id int, section_id int, text string")
    row = scan_mentions(df).where(F.col("date_text") == mention).first()
    assert row.sentence == expected and text[row.start_pos : row.end_pos] == mention


def test_positions_of_many_sentences_and_mentions(spark):
    text = " ".join(f"Item x{i} was in {1000 + i % 900}, or {i} BC." for i in range(1500))
    df = spark.createDataFrame([(1, 0, text)], "article_id int, section_id int, text string")
    rows = scan_mentions(df).collect()
    assert len(rows) == 3000 and all(text[r.start_pos : r.end_pos] == r.date_text for r in rows)
    # All in one sentence, more than one run of sums.
    text = ", ".join(f"{1000 + i}" for i in range(1000))
    df = spark.createDataFrame([(1, 0, text)], "article_id int, section_id int, text string")
    assert [text[r.start_pos : r.end_pos] for r in scan_mentions(df).collect()] == text.split(", ")
    assert {r.sentence for r in scan_mentions(df).collect()} == {text}


def test_many_mentions_take_linear_time(spark):
    import time

    text = " ".join(f"In {1000 + i % 1000} it rained." for i in range(8_000))
    df = spark.createDataFrame([(1, 0, text)], "article_id int, section_id int, text string")
    scan_mentions(df).count()
    start = time.perf_counter()
    assert scan_mentions(df).selectExpr("count(start_pos)", "max(length(sentence))").first()[0] == 8_000
    assert time.perf_counter() - start < 5


def test_forms_with_eras_weeks_hours_and_ranges(spark):
    def day(*a):
        return ("set", cal.civil_to_days(*a) * DAY, cal.civil_to_days(*a) * DAY + DAY - 1, "day")

    def years(low, high, grain="year"):
        return ("set", cal.civil_to_days(low, 1, 1) * DAY, cal.civil_to_days(high + 1, 1, 1) * DAY - 1, grain)

    forms = {
        "15 March 44 BC": day(-43, 3, 15), "March 15, 44 BC": day(-43, 3, 15), "5 Mar 2001": day(2001, 3, 5), "Sept 5, 2001": day(2001, 9, 5),
        "79 AD": years(79, 79), "AD 79": years(79, 79), "24 August 79 AD": day(79, 8, 24), "1914-1918": years(1914, 1918),
        "5th century BC": years(-499, -400, "century"), "12000 BC": years(-11999, -11999), "120s": years(120, 129, "decade"),
        "March 44 BC": ("set", cal.civil_to_days(-43, 3, 1) * DAY, cal.civil_to_days(-43, 4, 1) * DAY - 1, "month"),
        "2 weeks later": ("shift", 14, None, "day"), "3 hours earlier": ("shift", -180, None, "minute"), "90 minutes later": ("shift", 90, None, "minute"),
        "the previous week": ("shift", -7, None, "day"), "1000000 years later": ("shift", 10**6, None, "year"),
    }
    assert dict(zip(forms, ops(spark, *forms))) == forms
    assert found(spark, "; ".join(forms)) and [h[0] for h in found(spark, "; ".join(forms))] == list(forms)


@pytest.mark.parametrize("text", ["9" * 30 + " BC", "99999999999999 BC", "9999999999 years later", "0 AD", "1918-1914", "31 June 5 BC", "9" * 40 + "0s"])
def test_numbers_that_do_not_fit_are_found_and_fail(spark, text):
    assert [h[0] for h in found(spark, text)] == [text]
    assert ops(spark, text) == [("fail", None, None, None)]


def test_hours_move_the_clock():
    noon = seconds(2001, 3, 5) + 12 * 3600
    assert apply_op((noon, "minute"), "shift", 780, None, "minute") == (noon + 46_800, noon + 46_859, "minute")


def stored(spark, rows):
    """Rows of the stored event table that are open, in any order."""
    from articlelake.schemas import PARSED_EVENT

    return spark.createDataFrame([(a, s, None, None, None, t, p, p + len(t), None) for a, s, p, t in rows], PARSED_EVENT)


def intervals(events):
    return {(r.article_id, r.section_id, r.start_pos): (r.start_date, r.end_date, r.parse_status) for r in events.collect()}


def test_a_later_run_leans_on_what_was_resolved(spark):
    from articlelake.operators.events import resolve_events

    as_of = datetime(2024, 1, 1)
    known = resolve_events(stored(spark, [(1, 0, 0, "5 May 1990"), (2, 0, 0, "1914-1918")]), as_of)
    late = stored(spark, [(1, 1, 0, "2 days later"), (2, 3, 0, "the following month"), (3, 0, 0, "1 day later")])
    got = intervals(resolve_events(known.unionByName(late), as_of))
    assert got[1, 1, 0][0] == seconds(1990, 5, 7) and got[3, 0, 0][0] == seconds(2024, 1, 2)
    # The range keeps the grain of its form, not that of its length.
    assert got[2, 3, 0] == (seconds(1914, 2, 1), seconds(1914, 3, 1) - 1, 1)


def test_runs_in_any_order_end_alike(spark):
    """Sections in random batches, runs with random limits: the same events as one run over all."""
    import random

    from articlelake.operators.events import resolve_events, unresolved_events
    from articlelake.session import stage

    rng = random.Random(4)
    texts = ["1 day later", "the following month", "bad date", "3 years earlier", "29 February", "14:30", "90 minutes later", "1990s", "1914-1918", "19th century"]
    rows = [(a, s, p, rng.choice(texts) if rng.random() < 0.8 else f"{rng.randint(1, 28)} May {1900 + rng.randint(0, 99)}") for a in range(6) for s in range(5) for p in range(0, 60, 20)]
    as_of = datetime(2024, 1, 1)
    want = intervals(resolve_events(stored(spark, rows), as_of))
    places = [(a, s) for a in range(6) for s in range(5)]
    rng.shuffle(places)
    table = stored(spark, [])
    for batch in (places[:11], places[11:13], places[13:]):
        table = stage(table.unionByName(stored(spark, [r for r in rows if r[:2] in batch])), "t")
        for limit in (7, None):
            before = unresolved_events(table).count()
            table = stage(resolve_events(table, as_of, limit), "t")
            assert unresolved_events(table).count() == (0 if limit is None else max(0, before - limit))
    assert intervals(table) == want and len(want) == len(rows)
    again = stage(resolve_events(table, as_of), "t")
    assert intervals(again) == want


def test_composed_forms(spark):
    def span(low, high, grain):
        return ("set", seconds(*low), seconds(*high) - 1, grain)

    forms = {
        "3-5 May 1990": span((1990, 5, 3), (1990, 5, 6), "day"), "May to June 1990": span((1990, 5, 1), (1990, 7, 1), "month"),
        "Nov-Dec 1990": span((1990, 11, 1), (1991, 1, 1), "month"), "1990/91": span((1990, 1, 1), (1992, 1, 1), "year"),
        "1999/00": span((1999, 1, 1), (2001, 1, 1), "year"), "3rd of May 1990": span((1990, 5, 3), (1990, 5, 4), "day"),
        "21st May 1990": span((1990, 5, 21), (1990, 5, 22), "day"), "May 2nd, 1990": span((1990, 5, 2), (1990, 5, 3), "day"),
        "early 1990s": span((1990, 1, 1), (1994, 1, 1), "year"), "mid-1990s": span((1994, 1, 1), (1997, 1, 1), "year"),
        "Late 1990s": span((1997, 1, 1), (2000, 1, 1), "year"), "4th of July": ("fix", 7, 4, None), "July 4th": ("fix", 7, 4, None),
        "5 pm": ("clock", 17 * 3600, None, None), "12 am": ("clock", 0, None, None), "12:30 pm": ("clock", 12 * 3600 + 1800, None, None),
    }
    assert dict(zip(forms, ops(spark, *forms))) == forms
    assert [h[0] for h in found(spark, "; ".join(forms))] == list(forms)


@pytest.mark.parametrize("text", ["5-3 May 1990", "30-32 May 1990", "June to May 1990", "13 pm", "12:60 pm", "early 1995s", "29-30 February 1990"])
def test_composed_failures(spark, text):
    assert ops(spark, text) == [("fail", None, None, None)]


def test_the_scan_matches_a_text_once(spark):
    text = "K7 of 1990, \x01 May 5 to 3 days later. Sept 2nd, 2001\x01the next day; 1990/91 or AD 12x"
    df = spark.createDataFrame([(text,)], "t string").select(find_mentions(F.col("t")).alias("m"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert (plan.count("regexp_replace("), plan.count("regexp_extract_all(")) == (1, 0)
    found = [(m.date_text, text[m.start_pos : m.end_pos]) for m in df.first().m]
    assert [m for m, _ in found] == ["1990", "May 5", "3 days later", "Sept 2nd, 2001", "the next day", "1990/91"]
    assert all(a == b for a, b in found)


def test_digits_inside_of_words_are_not_scanned(spark):
    texts = {"K1990": False, "A1 B22_3": False, "no date": False, "mid-1990s": True, "AD 5": True, "(1990)": True, "the next day": True}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.hint for r in df.select("t", F.col("t").rlike(HINT).alias("hint")).collect()} == texts

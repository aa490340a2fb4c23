"""Disk and time of whole flows: what is not shuffled, not left behind, not done twice."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from articlelake.functions.folding import fold_letter, fold_title
from articlelake.operators import detail, events
from articlelake.operators.search import search_titles_loosely
from articlelake.plans import flows
from articlelake.schemas import TABLES
from articlelake.session import scratch_root, stage
from articlelake.sources.store import Store, lie_together

NOW = datetime(2024, 1, 1)


def section(article, number, text, parsed=None):
    return (article, number, 0, None, None, None, None, None, "PARAGRAPH", None, text, parsed)


def rows_of(store, name):
    return sorted(map(tuple, store.read(name).collect()), key=str)


def staged(spark, label):
    return [f for _, folders, _ in os.walk(scratch_root(spark)) for f in folders if f.startswith(f"{label}-")]


def test_event_flow_shuffles_no_sections_and_leaves_no_copies(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    files = [(f << 32) + a for f in (1, 2, 3) for a in range(40)]
    texts = [section(a, s, f"It was in {1900 + s}.") for a in files for s in range(3)]
    store.replace("article_section", spark.createDataFrame(texts, TABLES["article_section"]))
    assert "Join" not in events.pending_sections(store)._jdf.queryExecution().toString()
    before = [staged(spark, label) for label in ("events", "rewrite", "pending", "event-masks")]
    events.event_flow(store, NOW)
    assert [staged(spark, label) for label in ("events", "rewrite", "pending", "event-masks")] == before
    want = rows_of(store, "parsed_event")
    assert len(want) == 360 and all(r[2] is not None for r in want) and events.pending_sections(store).count() == 0
    store.replace("section_scan", store.read("section_scan").limit(0))
    events.event_flow(store, NOW)
    assert rows_of(store, "parsed_event") == want and events.pending_sections(store).count() == 0


def test_event_flow_keeps_events_of_other_sections(spark, tmp_path):
    """A section that comes later, beside scanned ones, an event of an unknown section and one without an article."""
    store = Store(spark, str(tmp_path / "lake"))
    one, two = (1 << 32) + 1, (2 << 32) + 1
    first = [section(one, 0, "It was in 1999."), section(two, 0, "It was in 1990."), section(two, 70, "It was in 1991.")]
    store.replace("article_section", spark.createDataFrame(first, TABLES["article_section"]))
    events.event_flow(store, NOW)
    odd = [(two, 500, 1, 2, 1, "1980", 0, 4, "1980"), (None, 1, None, None, None, "1995", 0, 4, "1995"), (one, None, 5, 6, 1, "y", 0, 1, "y")]
    store.append("parsed_event", spark.createDataFrame(odd, TABLES["parsed_event"]))
    later = [section(two, 64, "2 years later it ended."), section(one, 0, "It was in 1998.")]
    store.append("article_section", spark.createDataFrame(later, TABLES["article_section"]))
    events.event_flow(store, NOW)
    got = {(r.article_id, r.section_id, r.date_text): (r.start_date, r.parse_status) for r in store.read("parsed_event").collect()}
    assert got[(None, 1, "1995")] == (None, None) and got[(one, None, "y")] == (5, 1)
    year = lambda y: int((datetime(y, 1, 1) - datetime(1970, 1, 1)).total_seconds())
    # What follows a late section is resolved again.
    assert got[(two, 500, "1980")] == (year(1980), 1) and got[(two, 64, "2 years later")] == (year(1992), 1) and got[(one, 0, "1999")] == (year(1999), 1)
    assert len(got) == 7 and events.pending_sections(store).count() == 0


def test_staged_rows_that_lie_together(spark):
    rows = spark.range(40_000, numPartitions=4).select(F.expr("shiftleft(id % 20, 32) + 1").alias("article_id"))
    mixed, sorted_ = stage(rows, "mixed"), stage(rows.repartitionByRange(4, "article_id"), "sorted")
    assert lie_together(mixed, "parsed_event") == (set(range(20)), False)
    assert lie_together(sorted_, "parsed_event") == (set(range(20)), True)


def test_arriving_parts_are_packed(spark, sf):
    seen = len(staged(spark, "arriving"))
    flows.stream_ingest_parts(spark, sf)
    folders = [f"{top}/{f}" for top, names, _ in os.walk(scratch_root(spark)) for f in names if f.startswith("arriving-")]
    assert len(folders) == seen + 1
    newest = max(folders, key=os.path.getmtime)
    parts = [name for _, _, names in os.walk(newest) for name in names if name.startswith("part-")]
    assert parts and all(name.endswith(".txt.gz") for name in parts)


def test_long_titles_are_folded_in_one_pass(spark):
    """Letters that become several are replaced kind by kind, not looked up letter by letter; marks take no pattern."""
    text = "Straße Œuvre É Á ﬁ ё ИЙй ا آ Æther Á ñ 𐞃 カ" * 400
    df = spark.createDataFrame([(1, text), (2, "ß"), (3, "plain A"), (4, ""), (5, None)], "n int, t string").withColumn("f", fold_title(F.col("t")))
    plan = df._jdf.queryExecution().toString()
    assert "regexp_replace" not in plan and "try_element_at" not in plan
    got = {r.n: r.f for r in df.collect()}
    assert got[1] == "strasse oeuvre e a fi е ийй ا آ aether a n ʙ か".replace("ʙ", fold_letter("𐞃")) * 400
    assert [got[n] for n in (2, 3, 4, 5)] == ["ss", "plain a", "", None]
    part = spark.createDataFrame([(1, "Éa"), (2, "EA"), (3, "É")], "n int, t string").withColumn("title_srch", fold_title(F.col("t")))
    assert {r.n for r in search_titles_loosely(part, "éA").collect()} == {1, 2}


def test_article_detail_gathers_all_tables_at_once(spark):
    tables = {name: spark.createDataFrame([], TABLES[name]) for name in TABLES}
    ids = [(1 << 32) + i for i in range(3)]
    article = [(i, f"T{i}", None, None, None, 1, k, None, None, None, None, None) for k, i in enumerate(ids)]
    alias = (-5, "alias", None, None, None, None, None, None, "T", None, None, None)
    tables["article"] = spark.createDataFrame([*article, alias], TABLES["article"])
    rows = [section(ids[0], 1, "b"), section(ids[0], 0, "a"), section(ids[1], 0, "c"), section(None, 0, "x"), section(-5, 0, "y")]
    tables["article_section"] = spark.createDataFrame(rows, TABLES["article_section"])
    tables["article_section_format"] = spark.createDataFrame([(ids[1], 0, 1, 5, 6, "b", None), (ids[1], 0, 0, 1, 2, "a", "l")], TABLES["article_section_format"])
    bundles = detail.article_detail(tables)
    assert bundles.columns == [*tables["article"].columns, "article_section", "article_section_ext_text", "article_section_format", "parsed_event"]
    plan = bundles._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate [") == 1
    got = {r.id: r for r in bundles.collect()}
    assert set(got) == set(ids)
    assert [(s.section_id, s.text) for s in got[ids[0]].article_section] == [(0, "a"), (1, "b")] and got[ids[0]].article_section_format is None
    assert [(s.ord, s.format, s.link) for s in got[ids[1]].article_section_format] == [(0, "a", "l"), (1, "b", None)]
    assert got[ids[2]].article_section is None and got[ids[2]].parsed_event is None and got[ids[2]].article_section_ext_text is None

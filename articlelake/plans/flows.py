"""Registered queries of whole flows: parts that arrive later, refresh, detail on demand, events, stored constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chunks
from ..operators import checks, dates, detail, events, ingest, sections
from ..session import scratch_path, stage
from ..sources import archive, lines as src
from ..sources.store import Store
from ..streaming.ingest import ingest_stream
from . import corpus
from .corpus import AS_OF


def _long(*names) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def stream_ingest_parts(spark, d):
    """Every dump file arrives in two parts, the second after the first was ingested."""
    store, folder, offsets = Store(spark, scratch_path(spark, "stream")), scratch_path(spark, "arriving"), scratch_path(spark, "offsets")
    for half in ("dump_idx % 200 < 100", "dump_idx % 200 >= 100"):
        archive.write_files(corpus.pages(spark, d).where(half), folder, compress=True, value=corpus.document())
        ingest_stream(spark, folder, store, offsets, AS_OF, packed=True).awaitTermination()
    return store.read("article").where("dump_file_id is not null").select("id", "title")


# Shapes that dump articles lack ----------------------------------------------------------


def _rich(spark, d) -> DataFrame:
    return sections.parse_sections(corpus.rich_pages(spark, d), ["s_suppkey"])


def rich_sections(spark, d):
    rows = sections.section_rows(_rich(spark, d), ("s_suppkey",))
    return rows.select(
        "s_suppkey", *_long("section_id", "ext_text_count", "parent_section_id", "row_idx", "column_idx", "row_span", "column_span"),
        "tag", "format", "text",
    )


def section_paths(spark, d):
    """Depth, topmost section and path of every section of pages with nested lists and tables."""
    rows = sections.section_rows(_rich(spark, d), ("s_suppkey",))
    found = sections.section_paths(rows, ("s_suppkey",))
    return found.select("s_suppkey", *_long("section_id", "depth", "root"), F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def rich_spans(spark, d):
    return sections.format_spans(_rich(spark, d), ("s_suppkey",)).select(
        "s_suppkey", *_long("section_id", "ord", "start_pos", "end_pos"), "format"
    )


def rich_overflow(spark, d):
    """Text beyond the first stored piece, and the whole text put together again."""
    split = sections.section_rows(_rich(spark, d), ("s_suppkey",))
    ext = chunks.overflow_rows(split, ["s_suppkey", "section_id"])
    whole = chunks.full_text(split.drop("overflow"), ext, ("s_suppkey", "section_id")).where("ext_text_count > 0")
    pieces = ext.groupBy("s_suppkey", "section_id").agg(
        F.count(F.lit(1)).alias("pieces"), F.max(F.length("text")).cast("bigint").alias("longest")
    )
    return whole.join(pieces, ["s_suppkey", "section_id"]).select("s_suppkey", *_long("section_id"), "pieces", "longest", "text")


def _pages(spark, d) -> DataFrame:
    return sections.parse_sections(
        corpus.table(spark, d, "pages"), ["page_id"], title="url", extra_containers=("article", "main"), implied_p_end=True
    )


def page_paragraphs(spark, d):
    """Texts of the paragraphs of web pages, in order."""
    order = Window.partitionBy("page_id").orderBy("section_id")
    rows = _pages(spark, d).where("tag = 'PARAGRAPH'")
    return rows.select("page_id", (F.row_number().over(order) - 1).cast("bigint").alias("n"), "text")


# Events ----------------------------------------------------------------------------------


def date_forms(spark, d):
    found = dates.date_intervals(events.scan_mentions(corpus.dated_notes(spark, d)))
    return found.select("article_id", *_long("start_pos"), "date_text", "sentence", "start_date", "end_date", "grain")


def date_forms_composed(spark, d):
    """Dates made of two dates, or of a date and a word."""
    found = dates.date_intervals(events.scan_mentions(corpus.composed_notes(spark, d)))
    return found.select("article_id", *_long("start_pos"), "date_text", "start_date", "end_date", "grain")


def event_flow(spark, d):
    """The flow over stored tables, run again after a run whose log of scans was lost."""
    store = Store(spark, scratch_path(spark, "lake"))
    lines = corpus.lines(spark, d)
    fresh = detail.parse_into_tables(lines)
    for name in ("article_section", "article_section_ext_text", "article_section_format"):
        store.replace(name, fresh[name])
    events.event_flow(store, AS_OF)
    store.replace("section_scan", store.read("section_scan").limit(0))
    events.event_flow(store, AS_OF)
    keys = store.read("article_section").select("article_id", "section_id", "is_parsed")
    marks = events.with_scans(keys, store.read("section_scan"))
    titles = fresh["parsed"].where("section_id = 0").select("article_id", "title")
    found = store.read("parsed_event").join(marks, ["article_id", "section_id"]).join(titles, "article_id")
    return found.select(
        "title", *_long("section_id", "start_pos"), "date_text", "start_date", "end_date", *_long("parse_status"), "is_parsed"
    )


def resolve_dates_in_two_runs(spark, d):
    """Mentions that lean on each other, whose sections arrive in two batches, each resolved in two runs of which
    the first is limited to 1,000 events. The middle sections come last: what follows them is resolved again."""
    arriving = corpus.chained_mentions(spark, d)
    stored = arriving.limit(0)
    for batch in ("section_id <> 1", "section_id = 1"):
        stored = stored.unionByName(arriving.where(batch))
        for limit in (1000, None):
            stored = stage(events.resolve_events(stored, AS_OF, limit), "resolved")
    return stored.select("article_id", *_long("section_id", "start_pos"), "date_text", "start_date", "end_date", *_long("parse_status"))


def event_flow_of_late_sections(spark, d):
    """The flow over stored sections whose dates lean on each other; the middle section of each article comes last."""
    store = Store(spark, scratch_path(spark, "late"))
    arriving = stage(corpus.chained_sections(spark, d), "late-sections")
    for batch in ("section_id <> 1", "section_id = 1"):
        store.append("article_section", arriving.where(batch))
        events.event_flow(store, AS_OF)
    order = Window.partitionBy("article_id", "section_id").orderBy("start_pos")
    found = store.read("parsed_event").withColumn("n", F.row_number().over(order))
    return found.select("article_id", *_long("section_id", "n"), "date_text", "start_date", "end_date", *_long("parse_status"))


def unresolved_batch(spark, d):
    """The first 1,000 open events in reading order: the batch of one resolution run."""
    some = dates.date_intervals(corpus.chained_mentions(spark, d))
    return events.unresolved_events(some, limit=1000).select("article_id", *_long("section_id", "start_pos"), "date_text")


# Refresh and detail ------------------------------------------------------------------------


def old_sections(articles: DataFrame) -> DataFrame:
    """One outdated section for each dumped article."""
    return articles.where("dump_file_id is not null").select(
        F.col("id").alias("article_id"), F.lit(0).alias("section_id"), F.lit(0).alias("ext_text_count"),
        *[F.lit(None).cast("int").alias(c) for c in ("parent_section_id", "row_idx", "column_idx", "row_span", "column_span")],
        F.lit("HEADING").alias("tag"), F.lit(None).cast("string").alias("format"), F.lit("old").alias("text"),
        F.lit("Y").alias("is_parsed"),
    )


def before_refresh(spark, articles: DataFrame) -> dict[str, DataFrame]:
    tables = {name: Store(spark, scratch_path(spark, "none")).read(name) for name in detail.CHILD_TABLES}
    return {**tables, "article": articles, "article_section": old_sections(articles)}


def refresh_view(fresh: dict[str, DataFrame]) -> DataFrame:
    counts = fresh["article_section"].groupBy("article_id").agg(
        F.count(F.lit(1)).alias("sections"), F.count_if(F.col("text") == "old").alias("old_sections")
    )
    return fresh["article"].join(counts, F.col("id") == F.col("article_id")).select("id", "title", "err", "sections", "old_sections")


def refresh_unparseable(spark, d):
    """A third of the lines has no HTML, a third is absent: their articles keep their rows and get a state."""
    lines = corpus.lines(spark, d)
    articles = stage(ingest.ingest(lines, None, AS_OF).withColumn("err", F.lit("NEW_DUMP")), "article")
    bare = F.to_json(F.struct(
        F.get_json_object("value", "$.name").alias("name"), F.get_json_object("value", "$.url").alias("url"),
        F.struct(F.lit("x").alias("wikitext")).alias("article_body"),
    ))
    damaged = lines.where("dump_idx % 3 < 2").withColumn("value", F.when(F.col("dump_idx") % 3 == 1, bare).otherwise(F.col("value")))
    return refresh_view(detail.refresh_articles(before_refresh(spark, articles), damaged, AS_OF)).drop("id")


def articles_of_older_rules(spark, d):
    """Articles that are up to date, but were parsed before the rules changed."""
    articles = ingest.ingest(corpus.lines(spark, d), None, AS_OF).withColumn("err", F.lit("UP_TO_DATE"))
    newer = F.when(F.col("dump_idx") % 2 == 0, F.lit("2025-06-01 00:00:00").cast("timestamp")).otherwise(F.col("update"))
    return detail.needs_parse(articles.withColumn("update", newer), algorithm_date=detail.ALGORITHM_DATE).select("id", "title")


def _from_files(spark, d) -> tuple[str, DataFrame, DataFrame]:
    """Dump folder, its catalog, and the articles that its lines give."""
    folder = corpus.dump_folder(spark, d, compress=True)
    listed = src.list_files(spark, folder, packed=True)
    catalog = stage(src.upsert_catalog(src.empty_catalog(spark), listed), "catalog")
    return folder, catalog, ingest.ingest(src.read_lines(spark, folder, catalog, packed=True), None, AS_OF)


def refresh_wanted(spark, d):
    """From the dump files: only articles with a redirect are wanted, and only their files are opened."""
    folder, catalog, articles = _from_files(spark, d)
    articles = stage(articles.withColumn("err", F.lit("NEW_DUMP")), "article")
    wanted = articles.where("redirect is not null and dump_file_id is not null").select("id")
    fresh = detail.refresh_from_dumps(spark, folder, catalog, before_refresh(spark, articles), AS_OF, wanted, packed=True)
    return refresh_view(fresh).drop("id")


def article_detail_on_demand(spark, d):
    """Bundles of articles some of which are up to date: the others are parsed first."""
    folder, catalog, articles = _from_files(spark, d)
    articles = stage(articles.withColumn("err", F.when(F.col("redirect").isNull(), "UP_TO_DATE").otherwise("NEW_DUMP")), "article")
    wanted = articles.where("dump_file_id is not null and description is not null").select("id")
    bundles, _ = detail.detail_on_demand(spark, folder, catalog, before_refresh(spark, articles), AS_OF, wanted, packed=True)
    return bundles.select(
        "title", "err", F.size("article_section").cast("bigint").alias("sections"),
        F.col("article_section")[0]["text"].alias("first_text"),
    )


def stored_detail(spark, d):
    """Bundles of a few stored articles of one dump file, those not up to date parsed into the store first."""
    folder, catalog, articles = _from_files(spark, d)
    articles = articles.withColumn("err", F.when(F.col("redirect").isNull(), "UP_TO_DATE").otherwise("NEW_DUMP"))
    store = Store(spark, scratch_path(spark, "shelf"))
    store.replace("article", articles)
    # The stored rows are what the other tables are made from: no copy of them beside the store.
    for name, rows in before_refresh(spark, store.read("article")).items():
        if name != "article":
            store.replace(name, rows)
    ids = [r.id for r in store.read("article").where("dump_file_id = 1").orderBy("id").limit(40).select("id").collect()]
    bundles = detail.stored_detail(store, folder, catalog, AS_OF, ids, packed=True)
    return bundles.select("title", "err", F.size("article_section").cast("bigint").alias("sections"))


# Constraints -------------------------------------------------------------------------------


def stored_violations(spark, d):
    """Constraints of the stored tables, with faults put in: headings stored twice, spans of unknown sections."""
    lines = corpus.lines(spark, d)
    tables = detail.parse_into_tables(lines)
    parsed = tables.pop("parsed")
    # Scanned once: several constraints read the events.
    tables["parsed_event"] = stage(events.parsed_events(events.scan_mentions(parsed)), "events")
    tables["article"] = stage(ingest.ingest(lines, None, AS_OF), "article")
    spans = tables["article_section_format"]
    headings = tables["article_section"].where("section_id = 0 and article_id % 5 = 0")
    tables["article_section"] = tables["article_section"].unionByName(headings)
    lost = spans.where("section_id = 1 and ord = 0").withColumn("section_id", F.lit(1_000_000))
    tables["article_section_format"] = spans.unionByName(lost)
    return checks.stored_violations(tables)


FLOWS = {
    f.__name__: f
    for f in (
        stream_ingest_parts, rich_sections, section_paths, rich_spans, rich_overflow, page_paragraphs, date_forms, date_forms_composed, event_flow,
        resolve_dates_in_two_runs, event_flow_of_late_sections, unresolved_batch, articles_of_older_rules,
        refresh_unparseable, refresh_wanted, article_detail_on_demand, stored_detail, stored_violations,
    )
}

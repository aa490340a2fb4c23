"""Registered queries: each operator run over whole tables, or over dumps derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import article as fa
from ..functions import chunks
from ..functions.folding import fold_title
from ..operators import checks, dates, detail, events, ingest, search, sections
from ..session import discard, scratch_path, stage
from ..sources import archive, lines as src, offsets
from ..sources.store import Store
from ..streaming.ingest import ingest_stream
from . import corpus, flows
from .corpus import AS_OF, table

KEYS = ["article_id", "title"]


# Shared inputs -------------------------------------------------------------------------


def _parsed(spark, d) -> DataFrame:
    return sections.parse_articles(corpus.lines(spark, d))


def _rows(spark, d) -> DataFrame:
    return ingest.article_rows(corpus.lines(spark, d), AS_OF)


def _articles(spark, d) -> DataFrame:
    return ingest.ingest(corpus.lines(spark, d), None, AS_OF)


def _positions(spark, d) -> DataFrame:
    return corpus.articles(spark, d).select("c", "title", "dump_file_id", "file_name", "dump_idx")


def _catalog(spark, d) -> DataFrame:
    files = _positions(spark, d).select(F.col("dump_file_id").alias("id"), "file_name").distinct()
    return stage(files, "catalog")


def _dumps(spark, d) -> str:
    return corpus.dump_folder(spark, d, compress=True)


def _file_catalog(spark, folder: str) -> DataFrame:
    listed = src.list_files(spark, folder, packed=True)
    return stage(src.upsert_catalog(src.empty_catalog(spark), listed), "catalog")


def _file_lines(spark, d) -> DataFrame:
    folder = _dumps(spark, d)
    return src.read_lines(spark, folder, _file_catalog(spark, folder), packed=True)


def _earlier_run(spark, d) -> DataFrame:
    """Positions a previous run has ingested: the first three fifths of the customers."""
    last = table(spark, d, "customer").agg(F.max("c_custkey")).scalar()
    return _positions(spark, d).where(F.col("c") * 5 < last * 3)


def _document_sections(spark, d) -> tuple[DataFrame, DataFrame]:
    """Documents as stored sections: one section each, overflow apart, labelled ones scanned."""
    scanned = table(spark, d, "labels").select("doc_id").distinct().withColumn("is_parsed", F.lit("Y"))
    docs = table(spark, d, "documents").select("doc_id", "text").join(scanned, "doc_id", "left").select(
        F.col("doc_id").alias("article_id"), F.lit(0).alias("section_id"), "text", "is_parsed"
    )
    split = chunks.split_overflow(docs)
    return split.drop("overflow"), chunks.overflow_rows(split, ["article_id", "section_id"])


def _known_id() -> object:
    """Alias ids are hashes that an oracle cannot compute."""
    return F.when(F.col("id") > 0, F.col("id"))


def _long(*names) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# Sources -------------------------------------------------------------------------------


def dump_catalog_upsert(spark, d):
    known = _catalog(spark, d).where("id % 2 = 1").select(
        "id", "file_name", F.lit(0).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("modified")
    )
    listed = src.list_files(spark, _dumps(spark, d), packed=True)
    return src.upsert_catalog(known, listed).select("id", "file_name", (F.col("size") > 0).alias("refreshed"))


def _named(lines: DataFrame) -> DataFrame:
    return lines.select("dump_file_id", "file_name", "dump_idx", F.get_json_object("value", "$.name").alias("title"))


def article_lines(spark, d):
    return _named(_file_lines(spark, d))


def packed_article_lines(spark, d):
    target = scratch_path(spark, "packed")
    archive.pack(corpus.pages(spark, d), target, corpus.document())
    return _named(src.read_lines(spark, target, _file_catalog(spark, target), packed=True))


def lines_per_file(spark, d):
    return src.lines_per_file(src.scan_lines(spark, _dumps(spark, d), packed=True))


def article_lines_by_id(spark, d):
    wanted = _articles(spark, d).where("redirect is not null")
    found = src.lines_at(corpus.lines(spark, d), wanted)
    return found.select("article_id", F.get_json_object("value", "$.name").alias("title"))


def article_lines_by_offset(spark, d):
    """The line of every article, from byte ranges of its file, whose gzip members hold a few lines each."""
    folder = corpus.dump_folder(spark, d, ranged=True)
    catalog = _file_catalog(spark, folder)
    index = stage(offsets.line_offsets(spark, folder, catalog, packed=True), "offsets")
    wanted = src.read_lines(spark, folder, catalog, packed=True).select("dump_file_id", "dump_idx")
    return _named(offsets.read_lines_by_offset(spark, folder, catalog, index, wanted, packed=True))


def ingest_high_water(spark, d):
    return src.high_water(_earlier_run(spark, d))


def pending_files(spark, d):
    return src.pending_files(_catalog(spark, d), _earlier_run(spark, d))


def resume_lines(spark, d):
    return _named(src.resume_lines(corpus.lines(spark, d), _earlier_run(spark, d)))


def read_pending_lines(spark, d):
    folder = _dumps(spark, d)
    catalog = _file_catalog(spark, folder)
    done = stage(_earlier_run(spark, d), "done")
    return _named(src.read_pending_lines(spark, folder, catalog, done, packed=True))


# Ingest --------------------------------------------------------------------------------


def _article_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        _known_id().alias("id"), "title", "description", "dump_file_id", "dump_idx", "url", "redirect", "no_dates",
        F.unix_timestamp("wiki_update_ts").alias("wiki_update"), F.unix_timestamp("update").alias("updated"),
    )


def article_rows(spark, d):
    return _article_view(_rows(spark, d))


def rejected_lines(spark, d):
    """Good dump lines and, as a file of their own, document texts, which are no JSON."""
    texts = table(spark, d, "documents").select(
        F.lit(0).cast("bigint").alias("dump_file_id"), F.lit("texts").alias("file_name"),
        F.col("doc_id").alias("dump_idx"), F.col("text").alias("value"),
    )
    return ingest.rejected_lines(corpus.lines(spark, d).unionByName(texts))


def article_dedup(spark, d):
    return _article_view(ingest.first_titles(_rows(spark, d)))


def redirect_aliases(spark, d):
    return _rows(spark, d).where("alias_ord > 0").select(
        "title", "url", "redirect", F.col("alias_ord").cast("bigint").alias("alias_ord")
    )


def article_redirect_target(spark, d):
    return corpus.articles(spark, d).select("title", fa.redirect_target(corpus.wikitext()).alias("redirect"))


def article_description(spark, d):
    return table(spark, d, "documents").select("doc_id", fa.description(F.col("text")).alias("description"))


def dash_normalise(spark, d):
    return corpus.articles(spark, d).select("title", fa.hyphenate_dashes(F.col("html")).alias("html"))


def new_titles_only(spark, d):
    return ingest.new_titles_only(ingest.first_titles(_rows(spark, d)), _earlier_run(spark, d)).select("title", "redirect")


def ingest_resumed(spark, d):
    """Two runs: what the first one stored, then the rest appended."""
    lines = corpus.lines(spark, d)
    done = _earlier_run(spark, d).select("dump_file_id", "dump_idx")
    first = stage(ingest.ingest(lines.join(done, ["dump_file_id", "dump_idx"], "left_semi"), None, AS_OF), "run1")
    second = ingest.ingest(src.resume_lines(lines, first), first, AS_OF)
    return _article_view(first.unionByName(second))


def stream_ingest(spark, d):
    store = Store(spark, scratch_path(spark, "stream"))
    folder = _dumps(spark, d)
    ingest_stream(spark, folder, store, scratch_path(spark, "offsets"), AS_OF, packed=True).awaitTermination()
    return store.read("article").select("title", "url", "redirect", "description")


# Chunks and text -----------------------------------------------------------------------


def text_chunks(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(chunks.text_chunks(F.col("text"))).alias("count_id", "text")).select(
        "doc_id", *_long("count_id"), "text"
    )


def section_full_text(spark, d):
    kept, ext = _document_sections(spark, d)
    return chunks.full_text(kept, ext).select("article_id", *_long("ext_text_count"), "text")


def document_chunks_roundtrip(spark, d):
    whole = table(spark, d, "documents").select(F.col("doc_id").alias("article_id"), F.col("text").alias("original"))
    kept, ext = _document_sections(spark, d)
    return chunks.full_text(kept, ext).join(whole, "article_id").select(
        "article_id", (F.col("text") == F.col("original")).alias("same")
    )


def unparsed_sections(spark, d):
    kept, ext = _document_sections(spark, d)
    return events.unparsed_sections(kept, ext).select("article_id", "text")


def mark_sections_parsed(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("article_id"), F.lit(0).alias("section_id"), F.lit(None).cast("string").alias("is_parsed")
    )
    scanned = table(spark, d, "labels").select(F.col("doc_id").alias("article_id"), F.lit(0).alias("section_id"))
    return events.mark_parsed(docs, scanned).select("article_id", "is_parsed")


def strip_citations(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.regexp_count("text", F.lit(r"\[\d+\]")).cast("bigint").alias("citations"),
        fa.strip_citations(F.col("text")).alias("text"),
    )


def length_violations(spark, d):
    return checks.length_violations(table(spark, d, "documents"), {"text": 15000, "source": 4}, ["doc_id"]).select(
        "doc_id", "column_name", *_long("length", "max_length")
    )


# Sections ------------------------------------------------------------------------------


def section_rows(spark, d):
    return sections.section_rows(_parsed(spark, d), tuple(KEYS)).select(
        *KEYS, *_long("section_id", "ext_text_count", "parent_section_id", "row_idx", "column_idx", "row_span", "column_span"),
        "tag", "format", "text",
    )


def headings(spark, d):
    rows = _parsed(spark, d).where(F.col("tag").isin("HEADING", "TITLE", "SUBTITLE", "SUB_SUBTITLE"))
    return rows.select("title", *_long("section_id", "parent_section_id"), "tag", "text")


def paragraphs(spark, d):
    return _parsed(spark, d).where("tag = 'PARAGRAPH'").select("title", *_long("section_id"), "text")


def list_items(spark, d):
    return _parsed(spark, d).where("tag = 'LIST_ITEM'").select(
        "title", *_long("section_id", "parent_section_id"), "format", "text"
    )


def table_cells(spark, d):
    return _parsed(spark, d).where("tag = 'TABLE_CELL'").select(
        "title", *_long("row_idx", "column_idx", "row_span", "column_span"), "format", "text"
    )


def format_spans(spark, d):
    return sections.format_spans(_parsed(spark, d), tuple(KEYS)).select(
        "title", *_long("section_id", "start_pos", "end_pos"), "format", "link"
    )


def link_filter(spark, d):
    return sections.format_spans(_parsed(spark, d), tuple(KEYS)).where("format = 'a'").select("title", "link")


def boilerplate_removed(spark, d):
    """Boilerplate sections in the HTML of each article, and in its stored sections."""
    marked = F.size(F.regexp_extract_all("html", F.lit('id="References"'), F.lit(0))).cast("bigint")
    left = _parsed(spark, d).groupBy("title").agg(
        F.count(F.lit(1)).alias("sections"),
        F.count_if(F.col("text").contains("removed in") | F.col("text").contains("References")).alias("boilerplate"),
    )
    return left.join(corpus.articles(spark, d).select("title", marked.alias("in_html")), "title")


def section_children(spark, d):
    parsed = stage(_parsed(spark, d), "parsed")  # both sides of a self-join
    return sections.section_children(parsed, tuple(KEYS)).groupBy("title", "section_id", "tag").agg(
        F.count(F.lit(1)).alias("children"), F.max("child_id").cast("bigint").alias("last_child")
    ).select("title", *_long("section_id"), "tag", "children", "last_child")


def section_id_contiguity(spark, d):
    return checks.section_gaps(_parsed(spark, d), ("title",))


def page_links(spark, d):
    """Links among the spans of the section job, which reads the navigation like an article here."""
    pages = sections.parse_sections(table(spark, d, "pages"), ["page_id"], title="url", extra_containers=("article", "main", "nav"), implied_p_end=True)
    links = sections.format_spans(pages, ("page_id",)).where("format = 'a'")
    order = Window.partitionBy("page_id").orderBy("section_id", "ord")
    return links.select("page_id", (F.row_number().over(order) - 1).cast("bigint").alias("n"), "link")


def page_tag_counts(spark, d):
    tags = F.regexp_extract_all("html", F.lit("<([a-z][a-z0-9]*)[ >]"), F.lit(1))
    name = F.col("tag")
    kept = [*sections.HEADINGS, *sections.BLOCKS, *sections.FORMATS, *sections.TRANSPARENT, "tr", "caption", "body"]
    return table(spark, d, "pages").select(F.explode(tags).alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("n")
    ).select("tag", "n", F.when(name.isin(*kept), "walked").otherwise("dropped").alias("handling"))


def _page_sections(spark, d) -> DataFrame:
    pages = table(spark, d, "pages")
    return sections.parse_sections(
        pages, ["page_id"], title="url", extra_containers=("article", "main"), implied_p_end=True
    )


def page_sections(spark, d):
    return sections.section_rows(_page_sections(spark, d), ("page_id",)).drop("overflow")


def page_section_counts(spark, d):
    return _page_sections(spark, d).groupBy("page_id").agg(
        F.count_if(F.col("tag") == "PARAGRAPH").alias("paragraphs"),
        F.sum(F.size(F.filter("spans", lambda s: s["format"] == "b"))).alias("bold"),
    )


# Events --------------------------------------------------------------------------------


def date_mentions(spark, d):
    found = events.parsed_events(events.scan_mentions(_parsed(spark, d), tuple(KEYS)), tuple(KEYS))
    return found.select("title", *_long("section_id", "start_pos", "end_pos"), "date_text", "start_date", "end_date")


def event_sentences(spark, d):
    found = events.parsed_events(events.scan_mentions(_parsed(spark, d), tuple(KEYS)), tuple(KEYS))
    return found.select("title", *_long("section_id", "start_pos"), "display_text")


def date_intervals(spark, d):
    found = events.scan_mentions(_parsed(spark, d), tuple(KEYS))
    return dates.date_intervals(found).select(
        "title", *_long("section_id"), "date_text", "start_date", "end_date", "grain"
    )


def _resolved_view(resolved: DataFrame) -> DataFrame:
    return resolved.select(
        "article_id", *_long("section_id", "start_pos"), "date_text", "start_date", "end_date", "grain",
        *_long("parse_status"),
    )


def resolve_dates_article(spark, d):
    return _resolved_view(dates.resolve_dates(corpus.chained_mentions(spark, d), AS_OF))


def resolve_dates_section(spark, d):
    return _resolved_view(
        dates.resolve_dates(corpus.chained_mentions(spark, d), AS_OF, chain=("article_id", "section_id"))
    )


def unresolved_events(spark, d):
    some = dates.date_intervals(corpus.chained_mentions(spark, d))
    return events.unresolved_events(some).select("article_id", *_long("section_id", "start_pos"), "date_text")


def events_writeback(spark, d):
    stored = corpus.chained_mentions(spark, d)
    resolved = dates.resolve_dates(stored, AS_OF).where("start_date is not null")
    return events.write_back(stored, resolved).select(
        "article_id", *_long("section_id", "start_pos"), "start_date", "end_date", *_long("parse_status")
    )


def date_failure_context(spark, d):
    # Two of the three sections a chain refers to exist.
    known = table(spark, d, "customer").select(
        F.col("c_custkey").alias("article_id"), "c_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("section_id")
    ).select("article_id", "section_id", F.concat_ws(" section ", "c_name", F.col("section_id").cast("string")).alias("text"))
    resolved = dates.resolve_dates(corpus.chained_mentions(spark, d), AS_OF)
    return events.failure_context(resolved, known).select(
        "article_id", *_long("section_id", "start_pos"), "date_text", "context"
    )


def articles_without_dates(spark, d):
    lines = corpus.lines(spark, d)
    done = ingest.ingest(lines, None, AS_OF).withColumn("err", F.lit("UP_TO_DATE"))
    found = events.scan_mentions(sections.parse_articles(lines))
    return events.articles_without_dates(done, found).where("dump_file_id is not null").select("id", "title", "no_dates")


# Search --------------------------------------------------------------------------------


def title_search(spark, d):
    """Top 50 by title of a prefix search that meets aliases."""
    return search.search_titles(_articles(spark, d), "Alias Customer#", 50).select(
        "sub_title", _known_id().alias("id"), "title", "description"
    )


def title_search_wildcards(spark, d):
    return search.search_titles(_articles(spark, d), "%stomer#%_7%").select(
        "sub_title", _known_id().alias("id"), "title", "description"
    )


def redirect_resolve(spark, d):
    articles = stage(_articles(spark, d), "article")
    return search.resolve_redirects(articles, articles).select(
        "sub_title", _known_id().alias("id"), "title", "description"
    )


def title_search_ai_ci(spark, d):
    """With accent and capital in the search, by the collation."""
    docs = table(spark, d, "documents")
    return docs.where(search.title_matches_loosely(F.col("text"), "Él")).select("doc_id", "lang")


def title_search_folded(spark, d):
    """Prefix search with accent and capitals over document texts as titles, laid out by the folded title."""
    # Of a document only what the search returns is laid out. Folded once: the ranges are sampled from stored rows.
    titles = stage(table(spark, d, "documents").select("doc_id", fold_title(F.col("text")).alias("title_srch")), "folded")
    laid_out = stage(search.by_title(titles), "titles")
    discard(titles)
    found = [search.search_titles_loosely(laid_out, prefix).withColumn("prefix", F.lit(prefix)) for prefix in ("Éa", "th", "ÑA")]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("prefix", "doc_id", "title_srch")


def title_search_scripts(spark, d):
    """Titles in several scripts, found by prefixes without their accents, strokes, ligatures and capitals."""
    names = F.element_at(F.array(*[F.lit(name) for name in corpus.SCRIPTS]), (F.col("p_partkey") % len(corpus.SCRIPTS) + 1).cast("int"))
    titles = table(spark, d, "part").withColumn("title_srch", fold_title(F.concat(names, F.lit(" "), F.col("p_name"))))
    laid_out = stage(search.by_title(titles), "titles")
    found = [search.search_titles_loosely(laid_out, prefix).withColumn("prefix", F.lit(prefix)) for prefix in corpus.SCRIPTS.values()]
    return reduce(DataFrame.unionByName, found).select("prefix", "p_partkey", "title_srch")


def title_token_search(spark, d):
    return search.search_title_words(table(spark, d, "part"), "Ring small", title="p_name").select(
        "p_partkey", "p_name", *_long("matched")
    )


# Detail, refresh, checks ---------------------------------------------------------------


def article_with_dump(spark, d):
    return detail.article_with_dump(_articles(spark, d), _catalog(spark, d)).select("id", "title", "file_name")


def _with_states(articles: DataFrame) -> DataFrame:
    state = F.element_at(
        F.array(F.lit("UP_TO_DATE"), F.lit(None).cast("string"), F.lit("NEW_DUMP"), F.lit("PARSE_ERROR")),
        (F.col("dump_idx") % 4 + 1).cast("int"),
    )
    return articles.withColumn("err", state)


def articles_to_parse(spark, d):
    return detail.needs_parse(_with_states(_articles(spark, d))).select("id", "title")


def _tables(spark, d, articles: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    tables = detail.parse_into_tables(lines)
    parsed = tables.pop("parsed")
    found = events.parsed_events(events.scan_mentions(parsed))
    return {**tables, "parsed_event": found, "article": articles}


def refresh_articles(spark, d):
    """Old results are one outdated section per article; only up-to-date articles keep it."""
    lines = corpus.lines(spark, d)
    articles = stage(_with_states(ingest.ingest(lines, None, AS_OF)), "article")
    return flows.refresh_view(detail.refresh_articles(flows.before_refresh(spark, articles), lines, AS_OF))


def article_detail(spark, d):
    lines = corpus.lines(spark, d)
    bundles = detail.article_detail(_tables(spark, d, ingest.ingest(lines, None, AS_OF), lines))

    def joined(bundle, value):
        return F.coalesce(F.array_join(F.transform(bundle, value), "|"), F.lit(""))

    return bundles.select(
        "id", "title",
        joined("article_section", lambda s: F.concat_ws(":", s["section_id"].cast("string"), s["tag"], s["text"])).alias("sections"),
        F.coalesce(F.size("article_section_ext_text"), F.lit(0)).cast("bigint").alias("ext_texts"),
        joined("article_section_format", lambda s: F.concat_ws(":", s["format"], s["start_pos"].cast("string"))).alias("formats"),
        joined("parsed_event", lambda s: s["date_text"]).alias("events"),
    )


def article_parse_stats(spark, d):
    parsed = stage(_parsed(spark, d), "parsed")
    return detail.parse_stats(parsed, sections.article_section_format(parsed), events.scan_mentions(parsed))


def table_counts(spark, d):
    names = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
        "benchmark", "labels", "conversations",
    )
    return checks.table_counts({name: table(spark, d, name) for name in names})


def duplicate_keys(spark, d):
    return checks.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphan_rows(spark, d):
    return checks.orphan_rows(table(spark, d, "documents"), table(spark, d, "labels"), [("doc_id", "doc_id")]).select(
        "doc_id", "lang"
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated events per article: dump lines to sections to mentions to intervals."""
    found = events.scan_mentions(_parsed(spark, sf_dir), tuple(KEYS))
    return dates.date_intervals(found).groupBy("title").agg(
        F.count(F.lit(1)).alias("events"), F.min("start_date").alias("first_date"), F.max("end_date").alias("last_date")
    )


QUERIES = {
    f.__name__: f
    for f in (
        dump_catalog_upsert, article_lines, packed_article_lines, lines_per_file, article_lines_by_id, article_lines_by_offset,
        ingest_high_water, pending_files, resume_lines, read_pending_lines, article_rows, rejected_lines, article_dedup, redirect_aliases,
        article_redirect_target, article_description, dash_normalise, new_titles_only, ingest_resumed, stream_ingest,
        text_chunks, section_full_text, document_chunks_roundtrip, unparsed_sections, mark_sections_parsed,
        strip_citations, length_violations, section_rows, headings, paragraphs, list_items, table_cells, format_spans,
        link_filter, boilerplate_removed, section_children, section_id_contiguity, page_links, page_tag_counts,
        page_sections, page_section_counts, date_mentions, event_sentences, date_intervals, resolve_dates_article, resolve_dates_section,
        unresolved_events, events_writeback, date_failure_context, articles_without_dates, title_search,
        title_search_wildcards, title_search_folded, title_search_scripts, redirect_resolve, title_search_ai_ci, title_token_search, article_with_dump,
        articles_to_parse, refresh_articles, article_detail, article_parse_stats, table_counts, duplicate_keys, orphan_rows, flagship,
    )
}
QUERIES.update(flows.FLOWS)

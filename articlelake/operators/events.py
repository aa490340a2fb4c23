"""Date mentions as events: scan, queues, write-back, failure report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import full_text
from ..functions.mentions import HINT, find_in_sentences, sentence_around
from ..schemas import FAILED
from ..session import discard, stage
from ..sources.lines import MASKS_BROADCAST, position_masks
from ..sources.store import Store, bucket_of
from .dates import as_anchors, resolve_dates

EVENT_KEY = ["article_id", "section_id", "start_pos"]
# Fixed value: shown for a failed mention whose section is unknown.
NO_CONTEXT = "No context available"


def scan_mentions(sections: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Mentions of sections with complete ``text``, in reading order, with their sentence; native, no shuffle."""
    dated = sections.where((F.length("text") > 2) & F.col("text").rlike(HINT))
    found = dated.select(*keys, "section_id", "text", F.explode(find_in_sentences(F.col("text"))).alias("m"))
    around = sentence_around(F.col("text"), F.col("m.start_pos"), F.col("m.end_pos"))
    return found.select(
        *keys, "section_id", "m.date_text", "m.start_pos", "m.end_pos", F.coalesce("m.sentence", around).alias("sentence")
    )


def parsed_events(mentions: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Rows of ``parsed_event`` with open intervals. The description is the whole sentence; one wider than
    the stored column is reported by :func:`articlelake.operators.checks.stored_length_violations`."""
    return mentions.select(
        *keys,
        "section_id",
        F.lit(None).cast("bigint").alias("start_date"),
        F.lit(None).cast("bigint").alias("end_date"),
        F.lit(None).cast("int").alias("parse_status"),
        "date_text",
        "start_pos",
        "end_pos",
        F.col("sentence").alias("display_text"),
    )


def unparsed_sections(sections: DataFrame, ext_text: DataFrame) -> DataFrame:
    """Sections not scanned yet, with complete text. Only their own overflow is read."""
    return full_text(sections.where("is_parsed is null"), ext_text)


def mark_parsed(sections: DataFrame, scanned: DataFrame) -> DataFrame:
    """Set ``is_parsed`` on every scanned section, whether or not it had a mention."""
    done = scanned.select("article_id", "section_id").distinct().withColumn("_done", F.lit("Y"))
    return (
        sections.join(done, ["article_id", "section_id"], "left")
        .withColumn("is_parsed", F.coalesce("_done", "is_parsed"))
        .select(*sections.columns)
    )


def _is_open():
    """No interval yet. A failed mention is reported once and not selected again."""
    missing = F.col("start_date").isNull() | F.col("end_date").isNull()
    return missing & ~F.col("parse_status").eqNullSafe(FAILED)


def unresolved_events(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Events without an interval in article, section, position order; optionally the first
    ``limit`` of them."""
    ordered = events.where(_is_open()).orderBy(*EVENT_KEY)
    return ordered if limit is None else ordered.limit(limit)


def resolve_events(events: DataFrame, as_of: datetime, limit: int | None = None) -> DataFrame:
    """The event table after one resolution run over its open events, or the first ``limit`` of them.

    Chains go on from what earlier runs resolved. In each article that has an event of this run, everything
    from its first one on is resolved again, against the last event resolved before it: a mention
    that leans on a section which came later changes with it. So runs over sections in any order, or over
    batches, end with what one run over all gives. Other events pass through; open ones beyond the limit stay open.
    """
    place = F.struct("section_id", "start_pos")
    batch = events.where(_is_open()).select(*EVENT_KEY)
    if limit is not None:
        batch = stage(batch.orderBy(*EVENT_KEY).limit(limit), "event-batch")
        last = batch.agg(F.max(F.struct(*EVENT_KEY))).first()[0]
        beyond = F.lit(False) if last is None else F.struct(*EVENT_KEY) > F.struct(*[F.lit(x).cast(events.schema[k].dataType) for k, x in zip(EVENT_KEY, last)])
        later = _is_open() & beyond
    else:
        later = F.lit(False)
    first = batch.groupBy("article_id").agg(F.min(place).alias("_first"))
    reached = events.join(first, "article_id", "left").withColumn("_here", F.coalesce(place >= F.col("_first"), F.lit(False)) & ~later)
    # The last resolved event before the first of this run: one for each article, reduced before the shuffle.
    before = reached.where(F.col("_first").isNotNull() & (place < F.col("_first")) & F.col("start_date").isNotNull())
    context = ["section_id", "start_pos", "date_text", "start_date", "end_date"]
    earlier = before.groupBy("article_id").agg(F.max_by(F.struct(*context), place).alias("_e")).select("article_id", "_e.*")
    resolved = resolve_dates(reached.where("_here").select(*events.columns), as_of, earlier=as_anchors(earlier))
    return reached.where("not _here").select(*events.columns).unionByName(resolved.select(*events.columns))


def _resolve_new(events: DataFrame, as_of: datetime) -> DataFrame:
    """:func:`resolve_events` of open events alone, whose articles have no others: no event has to be looked up."""
    resolved = resolve_dates(events.where("article_id is not null"), as_of).select(*events.columns)
    return resolved.unionByName(events.where("article_id is null"))


def write_back(events: DataFrame, resolved: DataFrame) -> DataFrame:
    """Copy intervals of ``resolved`` into ``events``; other rows keep theirs."""
    new = resolved.select(
        *EVENT_KEY,
        F.col("start_date").alias("_start"),
        F.col("end_date").alias("_end"),
        F.col("parse_status").alias("_status"),
    )
    return (
        events.join(new, EVENT_KEY, "left")
        .withColumn("start_date", F.coalesce("_start", "start_date"))
        .withColumn("end_date", F.coalesce("_end", "end_date"))
        .withColumn("parse_status", F.coalesce("_status", "parse_status"))
        .select(*events.columns)
    )


def with_scans(sections: DataFrame, scans: DataFrame) -> DataFrame:
    """Sections as readers see them: ``is_parsed`` is set where the log of scans says so.

    The log is narrow and holds only what was scanned since the sections were written (see
    :func:`compact_scans`). For a few articles, filter both first."""
    return mark_parsed(sections, scans)


def _unscanned(store: Store, columns: list[str], logged: list[int], buckets: list[int] | None = None) -> DataFrame:
    """Stored sections, of the given dump files or of all, that are neither marked nor logged as scanned. Only
    those of dump files with a log, which are ``logged``, are looked up in it."""
    without = None if buckets is None else sorted(set(buckets) - set(logged))
    fresh = store.read("article_section", without, but=logged).where("is_parsed is null").select(*columns)
    if not logged:
        return fresh
    partly = store.read("article_section", logged).where("is_parsed is null").select(*columns)
    return fresh.unionByName(partly.join(store.read("section_scan", logged), ["article_id", "section_id"], "left_anti"))


def pending_sections(store: Store) -> DataFrame:
    """Keys of the sections not scanned yet. No text is read."""
    return _unscanned(store, ["article_id", "section_id"], _buckets(store.read("section_scan")))


def _section_masks(keyed: DataFrame, label: str) -> DataFrame:
    """The sections of ``keyed`` as bits, one row for 64 sections of an article."""
    keys = keyed.select(F.col("article_id").alias("dump_file_id"), F.col("section_id").cast("bigint").alias("dump_idx"))
    return stage(position_masks(keys).withColumnRenamed("dump_file_id", "article_id"), label)


def _buckets_with_others(stored: DataFrame, pending: DataFrame) -> list[int]:
    """Dump files of ``stored`` events that belong to no ``pending`` section. Masks of sections are compared, no event is moved."""
    held, dropped = _section_masks(stored, "event-masks"), _section_masks(pending, "pending-masks")
    right = dropped.withColumnRenamed("_mask", "_pending")
    if dropped.count() <= MASKS_BROADCAST:
        right = F.broadcast(right)
    left = F.col("_mask").bitwiseAND(F.bitwise_not(F.coalesce("_pending", F.lit(0))))
    # A key without an article or a section is equal to none.
    others = held.join(right, ["article_id", "_stretch"], "left").where(F.col("_mask").isNull() | (left != 0))
    found = _buckets(others)
    discard(held)
    discard(dropped)
    return found


def _buckets(*keyed: DataFrame) -> list[int]:
    """Dump files of the given rows: a number for each file, not for each row."""
    found = [rows.select(bucket_of("parsed_event").alias("b")).distinct() for rows in keyed]
    return sorted({r.b for rows in found for r in rows.collect()})


def event_flow(store: Store, as_of: datetime, limit: int | None = None) -> None:
    """Scan the sections not scanned yet, store their events, resolve what is open (or the first ``limit``
    open events of those files), log the scans.

    Only the folders of dump files with pending sections or open events are read and rewritten, and of
    sections only their keys are written, to the log: no text is copied. Events come first and the log last.
    Events of a section that is not logged are left from a run that broke off; they are dropped before the new
    ones are stored, so the flow can be run again at any point.
    """
    logged = _buckets(store.read("section_scan"))
    pending = _unscanned(store, ["article_id", "section_id"], logged)
    if logged:
        pending = stage(pending, "pending")
    fresh_buckets = _buckets(pending)
    buckets = sorted({*fresh_buckets, *_buckets(store.read("parsed_event").where(_is_open()))})
    if not buckets:
        return
    todo = _unscanned(store, ["article_id", "section_id", "ext_text_count", "text"], sorted({*logged} & {*fresh_buckets}), fresh_buckets)
    todo = full_text(todo, store.read("article_section_ext_text", fresh_buckets))
    stored = store.read("parsed_event", buckets)
    found_at = stage(parsed_events(scan_mentions(todo)), "events")
    found = found_at.select(*stored.columns)
    older = _buckets_with_others(stored, pending) if _buckets(stored) else []
    kept = store.read("parsed_event", older).join(pending, ["article_id", "section_id"], "left_anti")
    if limit is None:
        # Where nothing is kept, all events are new: their chains begin here.
        mixed = bucket_of("parsed_event").isin(older)
        resolved = _resolve_new(found.where(~mixed), as_of)
        if older:
            resolved = resolved.unionByName(resolve_events(kept.unionByName(found.where(mixed)), as_of))
    else:
        resolved = resolve_events(kept.unionByName(found), as_of, limit)
    store.rewrite("parsed_event", resolved, buckets)
    if fresh_buckets:
        store.append("section_scan", pending, together=not logged)
    discard(found_at)
    if logged:
        discard(pending)


def compact_scans(store: Store, buckets: list[int]) -> None:
    """Write the logged scans of these dump files into their sections and empty their log."""
    merged = with_scans(store.read("article_section", buckets), store.read("section_scan", buckets))
    store.rewrite("article_section", merged, buckets)
    store.rewrite("section_scan", store.read("section_scan", buckets).limit(0), buckets)


def failure_context(resolved: DataFrame, sections: DataFrame) -> DataFrame:
    """Failed mentions with the text of the section or cell they stand in."""
    failed = resolved.where(f"parse_status = {FAILED}")
    context = sections.select("article_id", "section_id", F.col("text").alias("_text"))
    return failed.join(context, ["article_id", "section_id"], "left").select(
        *[c for c in resolved.columns], F.coalesce("_text", F.lit(NO_CONTEXT)).alias("context")
    )


def articles_without_dates(articles: DataFrame, events: DataFrame) -> DataFrame:
    """Set ``no_dates`` on parsed articles: true when an article has no event."""
    dated = events.select(F.col("article_id").alias("id")).distinct().withColumn("_dated", F.lit(True))
    return (
        articles.join(dated, "id", "left")
        .withColumn("no_dates", F.when(F.col("err") == "UP_TO_DATE", F.col("_dated").isNull()).otherwise(F.col("no_dates")))
        .select(*articles.columns)
    )

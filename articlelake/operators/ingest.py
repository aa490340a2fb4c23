"""Lines to article rows: projection, redirect aliases, title uniqueness, resume."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import article as fa
from ..functions.folding import fold_title
from ..schemas import ARTICLE, INGEST_JSON
from ..sources.lines import read_pending_lines

_STORED = [
    "id", "title", "title_srch", "description", "update", "dump_file_id", "dump_idx", "url", "redirect",
    "no_dates", "wiki_update_ts", "err",
]
# Position of the line a row comes from; aliases store no dump position of their own.
_SOURCE = ["src_file_id", "src_idx", "alias_ord"]


def _with_document(lines: DataFrame) -> DataFrame:
    return lines.withColumn("j", F.from_json("value", INGEST_JSON, {"columnNameOfCorruptRecord": "_corrupt"}))


def _reject_reason():
    modified = F.col("j.date_modified")
    return (
        F.when(F.col("j._corrupt").isNotNull() | F.col("j").isNull(), "malformed")
        .when(F.col("j.name").isNull(), "no name")
        .when(F.col("j.url").isNull(), "no url")
        .when(F.col("j.article_body").isNull(), "no body")
        .when(modified.isNotNull() & fa.modified_time(modified).isNull(), "bad date_modified")
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that cannot become articles, with the reason."""
    return (
        _with_document(lines).withColumn("reason", _reject_reason())
        .where("reason is not null").select("dump_file_id", "file_name", "dump_idx", "reason")
    )


def article_rows(lines: DataFrame, as_of: datetime) -> DataFrame:
    """The article of each line followed by one alias row per named redirect.

    Both come out of one array per line, so the JSON is read and parsed once. Duplicated
    titles are still present; see :func:`first_titles`.
    """
    j = F.col("j")
    now = fa.job_time(as_of)
    modified = fa.modified_time(j["date_modified"])

    def row(**cells):
        types = dict(field.split(" ", 1) for field in ARTICLE.replace("`", "").split(", "))
        types.update(src_file_id="bigint", src_idx="bigint", alias_ord="int")
        return F.struct(*[cells.get(c, F.lit(None)).cast(types[c]).alias(c) for c in _STORED + _SOURCE])

    source = {"src_file_id": F.col("dump_file_id"), "src_idx": F.col("dump_idx")}
    article = row(
        id=fa.article_id(F.col("dump_file_id"), F.col("dump_idx")),
        title=j["name"],
        title_srch=fold_title(j["name"]),
        description=fa.description(j["abstract"]),
        update=now,
        dump_file_id=F.col("dump_file_id"),
        dump_idx=F.col("dump_idx"),
        url=j["url"],
        redirect=fa.redirect_target(j["article_body"]["wikitext"]),
        wiki_update_ts=modified,
        alias_ord=F.lit(0),
        **source,
    )

    def alias(entry, i):
        return row(
            id=fa.alias_id(entry["name"]),
            title=entry["name"],
            title_srch=fold_title(entry["name"]),
            update=now,
            url=entry["url"],
            redirect=j["name"],
            wiki_update_ts=modified,
            alias_ord=i + 1,
            **source,
        )

    entries = F.coalesce(j["redirects"], F.array().cast("array<struct<name:string,url:string>>"))
    aliases = F.filter(F.transform(entries, alias), lambda r: r["title"].isNotNull())
    rows = F.when(_reject_reason().isNull(), F.concat(F.array(article), aliases))
    # Generated from an expression, not a column: on a column the optimizer adds a
    # "not empty" filter that parses the JSON a second time.
    return _with_document(lines).select(F.inline(rows))


def first_titles(rows: DataFrame) -> DataFrame:
    """One row per title: the first in dump order. A title repeated very often is cut to one
    candidate per task before the shuffle (window group limit)."""
    order = Window.partitionBy("title").orderBy(*_SOURCE)
    return rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def new_titles_only(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose title is not stored yet; stored titles win."""
    return rows.join(stored.select("title"), "title", "left_anti")


def ingest(lines: DataFrame, stored: DataFrame | None, as_of: datetime) -> DataFrame:
    """New article rows of ``lines``, ready to append to ``stored``."""
    rows = first_titles(article_rows(lines, as_of))
    if stored is not None:
        rows = new_titles_only(rows, stored)
    return rows.select(*_STORED)


def ingest_dumps(
    spark: SparkSession, path, catalog: DataFrame, stored: DataFrame, as_of: datetime, packed: bool = False
) -> DataFrame:
    """Resume: read pending files, skip lines up to the high-water mark, project, dedup."""
    return ingest(read_pending_lines(spark, path, catalog, stored, packed), stored, as_of)


def with_metrics(lines: DataFrame, name: str = "ingest"):
    """Attach line count and size metrics, reported when the job finishes."""
    from pyspark.sql import Observation

    seen = Observation(name)
    observed = lines.observe(
        seen,
        F.count(F.lit(1)).alias("articles"),
        F.sum(F.length("value")).alias("chars"),
        F.avg(F.length("value")).alias("chars_per_article"),
    )
    return observed, seen

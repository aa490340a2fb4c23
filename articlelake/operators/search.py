"""Title search with one-hop redirect resolution."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold_title


def like_pattern(search: str) -> str:
    """Prefix search unless the text has its own ``%``; a backslash before any other
    character than a wildcard or backslash stands for that character."""
    pattern = search if "%" in search else search + "%"
    return re.sub(r"\\(.)", lambda m: m.group(0) if m.group(1) in "%_\\" else m.group(1), pattern, flags=re.S)


def by_title(articles: DataFrame, column: str = "title_srch") -> DataFrame:
    """The table laid out by its folded title, to be stored as ``article_title``: a prefix search then reads
    only the row groups whose title range it meets."""
    return articles.repartitionByRange(column).sortWithinPartitions(column)


def _resolved(hits: DataFrame, targets: DataFrame) -> DataFrame:
    rdr = targets.select(
        F.col("title").alias("r_title"), F.col("id").alias("r_id"), F.col("description").alias("r_description")
    )
    return hits.join(rdr, F.col("redirect") == F.col("r_title"), "left").select(
        F.col("title").alias("sub_title"),
        F.coalesce("r_id", "id").alias("id"),
        F.coalesce("r_title", "title").alias("title"),
        F.coalesce("r_description", "description").alias("description"),
    )


def resolve_redirects(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """Each row with id, title and description of its redirect target, if that exists.

    Most rows redirect nowhere. They skip the join, which would gather all NULL keys in
    one partition; frequent targets are left to adaptive skew splitting.
    """
    plain = hits.where("redirect is null").select(F.col("title").alias("sub_title"), "id", "title", "description")
    return plain.unionByName(_resolved(hits.where("redirect is not null"), articles))


def search_titles(articles: DataFrame, search: str, max_results: int | None = None) -> DataFrame:
    """``sub_title`` matched, and the ``id, title, description`` it leads to, by title.

    Titles are unique, so a limited search is cut to its ``max_results`` hits before the
    join. The redirect targets of these hits are then found by a semi join with at most that many titles.
    """
    if search == "":
        return _resolved(articles.where(F.lit(False)), articles)
    hits = articles.where(F.col("title").like(like_pattern(search))).select("id", "title", "redirect", "description")
    if max_results is None:
        return resolve_redirects(hits, articles)
    hits = hits.orderBy("title", "id").limit(max_results)
    wanted = hits.where("redirect is not null").select(F.col("redirect").alias("title")).distinct()
    targets = articles.select("id", "title", "description").join(wanted, "title", "left_semi")
    return _resolved(hits, targets).orderBy("sub_title", "id")


def title_matches_loosely(title, search: str):
    """Accent- and case-insensitive prefix test."""
    return F.startswith(F.collate(title, "UNICODE_CI_AI"), F.collate(F.lit(search), "UNICODE_CI_AI"))


def search_titles_loosely(articles: DataFrame, search: str) -> DataFrame:
    """Accent- and case-insensitive prefix search: a plain prefix of the stored folded title, which prunes."""
    if search == "":
        return articles.where(F.lit(False))
    return articles.where(F.startswith(F.col("title_srch"), fold_title(F.lit(search))))


def search_title_words(articles: DataFrame, search: str, title: str = "title") -> DataFrame:
    """Titles that hold every word of the search, with the number of matched words.

    Evaluated row by row on the word array; no explode and no shuffle.
    """
    words = sorted({w for w in re.split(r"\W+", search.lower()) if w})
    if not words:
        return articles.where(F.lit(False)).withColumn("matched", F.lit(0))
    title_words = F.split(F.lower(F.col(title)), r"\W+")
    matched = F.size(F.array_intersect(title_words, F.array(*[F.lit(w) for w in words])))
    return articles.withColumn("matched", matched).where(F.col("matched") == len(words))

"""Column expressions of the article projection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redirect marker, description limit, dash replacement.
REDIRECT_PATTERN = r"#REDIRECT\[\[([^\n]*)\]\]"
DESCRIPTION_LIMIT = 1000
DESCRIPTION_KEPT = 997
# Links that are not stored, by prefix and by content.
FILE_LINK = "./File:"
MISSING_PAGE = "redlink=1"


def article_id(dump_file_id: Column, dump_idx: Column) -> Column:
    """Id of a dumped article: its position, so ids grow in ingest order, are exact, and
    rows written in scan order are already clustered by id."""
    fits = (dump_file_id < F.lit(1 << 31)) & (dump_idx < F.lit(1 << 32))
    packed = F.shiftleft(dump_file_id.cast("bigint"), 32) + dump_idx.cast("bigint")
    return F.when(fits, packed).when(
        dump_file_id.isNotNull(), F.raise_error(F.lit("dump position does not fit an article id"))
    )


def dump_file_of(article_id: Column) -> Column:
    """Dump file of an article id; negative for aliases."""
    return F.shiftright(article_id, 32)


def alias_id(title: Column) -> Column:
    """Id of an alias row. Aliases own no child rows; negative ids keep them apart from
    dumped articles."""
    return -F.xxhash64(title).bitwiseAND(F.lit((1 << 63) - 1)) - F.lit(1)


def redirect_target(wikitext: Column) -> Column:
    """First ``#REDIRECT[[...]]`` target; greedy within its line, NULL when there is none."""
    return F.get(F.regexp_extract_all(wikitext, F.lit(REDIRECT_PATTERN), F.lit(1)), F.lit(0))


def modified_time(text: Column) -> Column:
    """UTC time ``yyyy-MM-ddTHH:mm:ssZ``; NULL for anything else."""
    return F.when(text.endswith("Z"), F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:sX")))


def job_time(as_of: datetime) -> Column:
    """The job's "now" as a timestamp; a time without zone is UTC."""
    return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)).cast("timestamp")


def description(abstract: Column) -> Column:
    return F.when(
        F.length(abstract) > DESCRIPTION_LIMIT,
        F.concat(F.substring(abstract, 1, DESCRIPTION_KEPT), F.lit("...")),
    ).otherwise(abstract)


def hyphenate_dashes(html: Column) -> Column:
    return F.replace(html, F.lit("–"), F.lit("-"))


def strip_citations(text: Column) -> Column:
    """Remove numeric citation marks such as ``[12]``."""
    return F.regexp_replace(text, r"\[\d+\]", "")


def kept_link(href: Column) -> Column:
    """False for file links and links to missing pages."""
    return ~(href.startswith(FILE_LINK) | href.contains(MISSING_PAGE))

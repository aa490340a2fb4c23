"""Article dumps on Spark: ingest, sections, dated events, search, detail."""

from .operators.detail import article_detail, refresh_articles
from .operators.events import resolve_events, scan_mentions
from .operators.ingest import ingest, ingest_dumps
from .operators.search import search_titles
from .operators.sections import parse_articles, parse_sections
from .session import build_session
from .sources.store import Store

__all__ = [
    "Store", "article_detail", "build_session", "ingest", "ingest_dumps", "parse_articles", "parse_sections",
    "refresh_articles", "resolve_events", "scan_mentions", "search_titles",
]

"""Fixed shapes: input JSON, stored tables, column length limits."""

# Input document, one per line. The ingest schema leaves the HTML out so that the JSON
# parser skips over it without materialising it.
INGEST_JSON = (
    "name string, url string, article_body struct<wikitext:string>, date_modified string, "
    "abstract string, redirects array<struct<name:string,url:string>>, _corrupt string"
)
BODY_JSON = "name string, url string, article_body struct<html:string>, _corrupt string"

DUMP_FILE = "id bigint, file_name string, size bigint, modified timestamp"

# Lines of each part that the stream has ingested.
DUMP_PART = "file_name string, file_path string, lines bigint"

# Bytes of each stretch of lines of a physical file.
LINE_OFFSET = (
    "dump_file_id bigint, file_name string, file_path string, file_size bigint, modified timestamp, "
    "stretch bigint, first_idx bigint, lines bigint, start bigint, stop bigint"
)

ARTICLE = (
    "id bigint, title string, title_srch string, description string, `update` timestamp, "
    "dump_file_id bigint, dump_idx bigint, url string, redirect string, no_dates boolean, "
    "wiki_update_ts timestamp, err string"
)

ARTICLE_SECTION = (
    "article_id bigint, section_id int, ext_text_count int, parent_section_id int, row_idx int, "
    "column_idx int, row_span int, column_span int, tag string, format string, text string, "
    "is_parsed string"
)

ARTICLE_SECTION_EXT_TEXT = "article_id bigint, section_id int, count_id int, text string"

ARTICLE_SECTION_FORMAT = (
    "article_id bigint, section_id int, ord int, start_pos int, end_pos int, format string, link string"
)

PARSED_EVENT = (
    "article_id bigint, section_id int, start_date bigint, end_date bigint, "
    "parse_status int, date_text string, start_pos int, end_pos int, display_text string"
)

# Sections that were scanned for mentions since their rows were written: merged into ``is_parsed`` on reading.
SECTION_SCAN = "article_id bigint, section_id int"

# The article table again, in order of the folded title.
ARTICLE_TITLE = ARTICLE

TABLES = {
    "dump_file": DUMP_FILE,
    "dump_part": DUMP_PART,
    "line_offset": LINE_OFFSET,
    "article": ARTICLE,
    "article_title": ARTICLE_TITLE,
    "article_section": ARTICLE_SECTION,
    "article_section_ext_text": ARTICLE_SECTION_EXT_TEXT,
    "article_section_format": ARTICLE_SECTION_FORMAT,
    "parsed_event": PARSED_EVENT,
    "section_scan": SECTION_SCAN,
}

CHILD_TABLES = (
    "article_section",
    "article_section_ext_text",
    "article_section_format",
    "parsed_event",
)

# Tables kept in one folder per dump file, and the id that holds the file's number.
BUCKETED = {
    "article": "id",
    "article_section": "article_id",
    "article_section_ext_text": "article_id",
    "article_section_format": "article_id",
    "parsed_event": "article_id",
    "section_scan": "article_id",
}

PRIMARY_KEYS = {
    "dump_file": ("id",),
    "dump_part": ("file_path",),
    "line_offset": ("dump_file_id", "stretch", "file_path"),
    "article": ("id",),
    "article_title": ("id",),
    "article_section": ("article_id", "section_id"),
    "article_section_ext_text": ("article_id", "section_id", "count_id"),
    "article_section_format": ("article_id", "section_id", "ord"),
    "parsed_event": ("article_id", "section_id", "start_pos"),
    "section_scan": ("article_id", "section_id"),
}

# Columns that must name a row of another table, and that table's columns.
FOREIGN_KEYS = {
    "article_section": [(("article_id",), "article", ("id",))],
    "article_section_ext_text": [(("article_id", "section_id"), "article_section", ("article_id", "section_id"))],
    "article_section_format": [(("article_id", "section_id"), "article_section", ("article_id", "section_id"))],
    "parsed_event": [(("article_id", "section_id"), "article_section", ("article_id", "section_id"))],
    "section_scan": [(("article_id", "section_id"), "article_section", ("article_id", "section_id"))],
}

# Stored column widths in characters.
MAX_LENGTHS = {
    "dump_file": {"file_name": 400},
    "article": {"title": 400, "title_srch": 400, "description": 1000, "url": 600, "redirect": 600,
                "err": 30},
    "article_section": {"tag": 40, "format": 200, "text": 15000, "is_parsed": 1},
    "article_section_ext_text": {"text": 15000},
    "article_section_format": {"format": 64, "link": 1000},
    "parsed_event": {"date_text": 200, "display_text": 500},
}

# Article states.
UP_TO_DATE = "UP_TO_DATE"
NEW_DUMP = "NEW_DUMP"
PARSE_ERROR = "PARSE_ERROR"

# parse_status of an event after date resolution.
RESOLVED = 1
FAILED = 2

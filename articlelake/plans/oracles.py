"""Expected results of the registered queries as DuckDB SQL.

Nothing here parses HTML, JSON or dates out of text: the expectations are computed from the
relations the dumps were derived from (layout in FIXTURES.md).
"""

from __future__ import annotations

_ORDERS = """
o AS (
  SELECT o_custkey AS c, o_orderkey // 100000 AS page, o_orderkey AS key, 'K' || o_orderkey AS name,
    o_orderstatus AS status, o_orderpriority AS priority, o_orderdate::DATE AS d, year(o_orderdate) AS y,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%-d %B %Y')
      WHEN 1 THEN strftime(o_orderdate, '%B %Y')
      WHEN 2 THEN strftime(o_orderdate, '%Y')
      WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y')
      WHEN 5 THEN (year(o_orderdate) - year(o_orderdate) % 10) || 's'
      WHEN 6 THEN CASE WHEN year(o_orderdate) > 2000 THEN '21st century' ELSE '20th century' END
      ELSE year(o_orderdate) || ' BC' END AS date_text,
    row_number() OVER (PARTITION BY o_custkey, o_orderkey // 100000 ORDER BY o_orderkey) AS k
  FROM orders),
a AS (
  SELECT c_custkey AS c, coalesce(p.page, 0) AS page, c_name, n_name, c_mktsegment, coalesce(p.n, 0) AS n,
    CASE WHEN coalesce(p.page, 0) = 0 THEN c_name ELSE c_name || ' page ' || p.page END AS title,
    c_custkey // 200 + 1 AS dump_file_id,
    'dump_' || lpad((c_custkey // 200 + 1)::VARCHAR, 9, '0') || '.ndjson' AS file_name,
    c_custkey % 200 + 200 * coalesce(p.page, 0) AS dump_idx,
    (c_custkey // 200 + 1) * 4294967296 + c_custkey % 200 + 200 * coalesce(p.page, 0) AS article_id,
    'https://wiki.example.org/wiki/' || c_custkey AS url
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT c, page, count(*) AS n FROM o GROUP BY ALL) p ON p.c = c_custkey)
"""

_ROWS = """
r AS (
  SELECT article_id AS id, title, dump_file_id, dump_idx, url,
    CASE WHEN c % 11 <> 0 AND c % 10 = 7 THEN 'Customer#' || lpad((c - 1)::VARCHAR, 9, '0') END AS redirect,
    CASE WHEN c % 13 <> 0 THEN
      CASE WHEN length(repeat(c_mktsegment || ' account, ', c % 90)) > 1000
        THEN left(repeat(c_mktsegment || ' account, ', c % 90), 997) || '...'
        ELSE repeat(c_mktsegment || ' account, ', c % 90) END END AS description,
    CASE WHEN c % 17 <> 0 THEN 1704067200 + c % 100000 * 3600 END AS wiki_update,
    dump_file_id AS sf, dump_idx AS si, 0 AS ord
  FROM a
  UNION ALL
  SELECT NULL, 'Alias ' || title, NULL, NULL, CASE WHEN c % 3 <> 0 THEN url || '/alias' END, title, NULL,
    CASE WHEN c % 17 <> 0 THEN 1704067200 + c % 100000 * 3600 END, dump_file_id, dump_idx, 1
  FROM a WHERE c % 5 <> 0
  UNION ALL
  SELECT NULL, 'Customer#' || lpad((CASE WHEN c % 50 = 49 THEN c - 1 ELSE c + 1 END)::VARCHAR, 9, '0'), NULL, NULL, url,
    title, NULL, CASE WHEN c % 17 <> 0 THEN 1704067200 + c % 100000 * 3600 END, dump_file_id, dump_idx, 3
  FROM a WHERE c % 5 <> 0 AND c % 50 IN (24, 49)),
art AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY title ORDER BY sf, si, ord) = 1)
"""

_SECTIONS = """
s AS (
  SELECT article_id, title, 0 AS section_id, NULL AS parent, 'HEADING' AS tag, NULL AS format, title AS text,
    NULL AS ri, NULL AS ci, NULL AS rs, NULL AS cs FROM a
  UNION ALL SELECT article_id, title, 1, 0, 'PARAGRAPH', NULL,
    'Customer ' || c_name || ' lives in ' || n_name || ' - see file and new', NULL, NULL, NULL, NULL FROM a
  UNION ALL SELECT article_id, title, 2, 0, 'TITLE', NULL, 'Orders', NULL, NULL, NULL, NULL FROM a
  UNION ALL SELECT article_id, title, 3, 0, 'TABLE', NULL, '', NULL, NULL, NULL, NULL FROM a
  UNION ALL SELECT article_id, title, 4, 3, 'TABLE_CELL', 'th', 'Key', 0, 0, 1, 2 FROM a
  UNION ALL SELECT article_id, title, 5, 3, 'TABLE_CELL', 'th', 'Date', 0, 1, 1, 1 FROM a
  UNION ALL SELECT article_id, title, 3 + 3 * k + i, 3, 'TABLE_CELL', 'td',
    CASE i WHEN 0 THEN name WHEN 1 THEN status ELSE date_text END, k, i, 1, 1
    FROM a JOIN o USING (c, page), (VALUES (0), (1), (2)) t(i)
  UNION ALL SELECT article_id, title, 6 + 3 * n, 0, 'SUBTITLE', NULL, 'History', NULL, NULL, NULL, NULL FROM a
  UNION ALL SELECT article_id, title, 7 + 3 * n, 0, 'LIST', NULL, '', NULL, NULL, NULL, NULL FROM a
  UNION ALL SELECT article_id, title, 7 + 3 * n + k, 7 + 3 * n, 'LIST_ITEM', 'li',
    'Order ' || name || ' was placed on ' || date_text || '. It is ' || priority || '.', NULL, NULL, NULL, NULL
    FROM a JOIN o USING (c, page))
"""

_MENTIONS = """
span AS (
  SELECT key,
    CASE WHEN key % 8 IN (0, 3, 4) THEN d
      WHEN key % 8 = 1 THEN date_trunc('month', d)::DATE
      WHEN key % 8 = 2 THEN make_date(y, 1, 1)
      WHEN key % 8 = 5 THEN make_date(y - y % 10, 1, 1)
      WHEN key % 8 = 6 THEN make_date((y - 1) // 100 * 100 + 1, 1, 1)
      ELSE make_date(1 - y, 1, 1) END AS first_day,
    CASE WHEN key % 8 IN (0, 3, 4) THEN 'day' WHEN key % 8 = 1 THEN 'month' WHEN key % 8 IN (2, 7) THEN 'year'
      WHEN key % 8 = 5 THEN 'decade' ELSE 'century' END AS grain
  FROM o),
m AS (
  SELECT article_id, title, section_id, start_pos, start_pos + length(date_text) AS end_pos, date_text, sentence, key,
    epoch(first_day)::BIGINT AS start_date,
    (epoch(CASE grain WHEN 'day' THEN first_day + INTERVAL 1 DAY WHEN 'month' THEN first_day + INTERVAL 1 MONTH
      WHEN 'year' THEN first_day + INTERVAL 1 YEAR WHEN 'decade' THEN first_day + INTERVAL 10 YEAR
      ELSE first_day + INTERVAL 100 YEAR END) - 1)::BIGINT AS end_date, grain
  FROM (
    SELECT article_id, title, 5 + 3 * k AS section_id, 0 AS start_pos, date_text, date_text AS sentence, key
    FROM a JOIN o USING (c, page)
    UNION ALL
    SELECT article_id, title, 7 + 3 * n + k, length('Order ' || name || ' was placed on '), date_text,
      'Order ' || name || ' was placed on ' || date_text || '.', key
    FROM a JOIN o USING (c, page)) JOIN span USING (key))
"""

def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_A = _with(_ORDERS)
_R = _with(_ORDERS, _ROWS)
_S = _with(_ORDERS, _SECTIONS)
_M = _with(_ORDERS, _MENTIONS)
_EARLIER = "c * 5 < (SELECT max(c_custkey) * 3 FROM customer)"
_VIEW = """id, title, description, dump_file_id, dump_idx, url, redirect, NULL::BOOLEAN AS no_dates, wiki_update,
  1704067200::BIGINT AS updated"""


def _long(*names: str) -> str:
    return ", ".join(f"{n}::BIGINT AS {n}" for n in names)


def _chain(partition: str, article: str = "o_custkey") -> str:
    """The chained mentions resolved one by one with a recursive query."""
    return f"""
WITH RECURSIVE q AS (
  SELECT {article} AS article_id, o_orderkey % 3 AS section_id, o_orderkey AS start_pos, o_orderkey % 7 AS kind,
    o_orderdate::DATE AS d,
    CASE WHEN o_orderkey % 7 <= 1 THEN strftime(o_orderdate, '%-d %B %Y')
      ELSE CASE o_orderkey % 7 WHEN 2 THEN '2 years later' WHEN 3 THEN '3 days earlier' WHEN 4 THEN 'bad date'
        WHEN 5 THEN 'the following month' ELSE strftime(o_orderdate, '%-d %B') END END AS date_text,
    row_number() OVER (PARTITION BY {partition} ORDER BY o_orderkey % 3, o_orderkey) AS i
  FROM orders),
q1 AS (SELECT *, {"article_id::VARCHAR" if partition == article else "article_id || '/' || section_id"} AS chain FROM q),
f AS (
  SELECT chain, 0::BIGINT AS i, DATE '2024-01-01' AS ref, NULL::DATE AS val FROM (SELECT DISTINCT chain FROM q1)
  UNION ALL
  SELECT chain, i, coalesce(val, ref), val FROM (
    SELECT q1.chain, q1.i, f.ref,
      CASE WHEN kind <= 1 THEN d WHEN kind = 2 THEN (ref + INTERVAL 2 YEAR)::DATE
        WHEN kind = 3 THEN ref - 3 WHEN kind = 4 THEN NULL WHEN kind = 5 THEN (ref + INTERVAL 1 MONTH)::DATE
        ELSE try_cast(printf('%04d-%02d-%02d', year(ref), month(d), day(d)) AS DATE) END AS val
    FROM f JOIN q1 ON q1.chain = f.chain AND q1.i = f.i + 1)),
z AS (
  SELECT article_id, section_id::BIGINT AS section_id, start_pos, date_text, epoch(val)::BIGINT AS start_date,
    epoch(val)::BIGINT + 86399 AS end_date, CASE WHEN val IS NOT NULL THEN 'day' END AS grain,
    CASE WHEN val IS NULL THEN 2 ELSE 1 END::BIGINT AS parse_status
  FROM q1 JOIN f USING (chain, i))
"""


# Articles of a customer's orders, cut by order keys.
_PAGES = "o_custkey * 1048576 + o_orderkey // 100000"


def _lines(where: str = "TRUE") -> str:
    return f"{_A} SELECT dump_file_id, file_name, dump_idx, title FROM a WHERE {where}"


# Lines read from files: file ids are name ranks, line numbers are ranks within the file.
_FILE_LINES = f"""{_A} SELECT dense_rank() OVER (ORDER BY file_name) AS dump_file_id, file_name,
  row_number() OVER (PARTITION BY file_name ORDER BY dump_idx) - 1 AS dump_idx, title FROM a"""

_RESOLVED = """
  SELECT x.title AS sub_title, CASE WHEN t.title IS NULL THEN x.id ELSE t.id END AS id,
    coalesce(t.title, x.title) AS title, coalesce(t.description, x.description) AS description
  FROM art x LEFT JOIN art t ON x.redirect = t.title"""

_HTML = """
  SELECT title, '<html><head><title>' || c_name || '</title></head><body><section><p>Customer <b>' || c_name
    || '</b> lives in <a href="./' || n_name || '">' || n_name
    || '</a> - see <a href="./File:x.png">file</a> and <a href="./New?redlink=1">new</a></p></section>'
    || '<section><h2>Orders</h2><table><thead><tr><th colspan="2">Key</th><th>Date</th></tr></thead><tbody>'
    || coalesce(cells, '') || '</tbody></table></section><section><h3>History</h3><ul>' || coalesce(items, '')
    || '</ul></section><section><h2 id="References">References</h2><p>removed in 1999</p></section></body></html>' AS html
  FROM a LEFT JOIN (
    SELECT c, page,
      string_agg('<tr><td>' || name || '</td><td>' || status || '</td><td>' || date_text || '</td></tr>', '' ORDER BY key) AS cells,
      string_agg('<li>Order ' || name || ' was placed on ' || date_text || '. It is ' || priority || '.</li>', '' ORDER BY key) AS items
    FROM o GROUP BY ALL) USING (c, page)"""

_STATE = "CASE dump_idx % 4 WHEN 0 THEN 'UP_TO_DATE' WHEN 2 THEN 'NEW_DUMP' WHEN 3 THEN 'PARSE_ERROR' END"

ORACLES = {
    "dump_catalog_upsert": f"""{_A}, k AS (SELECT DISTINCT dump_file_id, file_name FROM a),
      e AS (SELECT dump_file_id AS id, file_name FROM k WHERE dump_file_id % 2 = 1)
      SELECT id, file_name, TRUE AS refreshed FROM e
      UNION ALL
      SELECT (SELECT max(id) FROM e) + row_number() OVER (ORDER BY file_name), file_name, TRUE FROM k
      WHERE dump_file_id % 2 = 0""",
    "article_lines": _FILE_LINES,
    "packed_article_lines": _FILE_LINES,
    "article_lines_by_offset": _FILE_LINES,
    "lines_per_file": f"{_A} SELECT file_name, count(*) AS lines FROM a GROUP BY file_name",
    "article_lines_by_id": f"{_R} SELECT id AS article_id, title FROM art WHERE redirect IS NOT NULL AND id IS NOT NULL",
    "ingest_high_water": f"""{_A}, e AS (SELECT * FROM a WHERE {_EARLIER})
      SELECT dump_file_id, max(dump_idx) AS dump_idx FROM e
      WHERE dump_file_id = (SELECT max(dump_file_id) FROM e) GROUP BY 1""",
    "pending_files": f"""{_A} SELECT DISTINCT dump_file_id AS id, file_name FROM a
      WHERE dump_file_id >= (SELECT max(dump_file_id) FROM a WHERE {_EARLIER})""",
    "resume_lines": f"""{_A}, h AS (SELECT dump_file_id AS f, max(dump_idx) AS i FROM a
        WHERE {_EARLIER} AND dump_file_id = (SELECT max(dump_file_id) FROM a WHERE {_EARLIER}) GROUP BY 1)
      SELECT dump_file_id, file_name, dump_idx, title FROM a, h
      WHERE dump_file_id > f OR (dump_file_id = f AND dump_idx > i)""",
    # Stored positions are the corpus's own, the lines' are ranks in the files; see _FILE_LINES.
    "read_pending_lines": f"""{_A}, h AS (SELECT dump_file_id AS f, max(dump_idx) AS i FROM a
        WHERE {_EARLIER} AND dump_file_id = (SELECT max(dump_file_id) FROM a WHERE {_EARLIER}) GROUP BY 1),
      x AS (SELECT dense_rank() OVER (ORDER BY file_name) AS dump_file_id, file_name,
        row_number() OVER (PARTITION BY file_name ORDER BY dump_idx) - 1 AS dump_idx, title FROM a)
      SELECT x.* FROM x, h WHERE dump_file_id > f OR (dump_file_id = f AND dump_idx > i)""",
    "article_rows": f"{_R} SELECT {_VIEW} FROM r",
    "rejected_lines": """SELECT 0::BIGINT AS dump_file_id, 'texts' AS file_name, doc_id AS dump_idx, 'malformed' AS reason
      FROM documents""",
    "article_dedup": f"{_R} SELECT {_VIEW} FROM art",
    "ingest_resumed": f"{_R} SELECT {_VIEW} FROM art",
    "stream_ingest": f"{_R} SELECT title, url, redirect, description FROM art",
    "redirect_aliases": f"{_R} SELECT title, url, redirect, ord::BIGINT AS alias_ord FROM r WHERE ord > 0",
    "article_redirect_target": f"{_R} SELECT title, redirect FROM r WHERE ord = 0",
    "article_description": """SELECT doc_id, CASE WHEN length(text) > 1000 THEN left(text, 997) || '...' ELSE text END
      AS description FROM documents""",
    "dash_normalise": f"{_A} {_HTML}",
    "new_titles_only": f"""{_R} SELECT title, redirect FROM art
      WHERE title NOT IN (SELECT title FROM a WHERE {_EARLIER})""",
    "text_chunks": """SELECT doc_id, i::BIGINT AS count_id, substring(text, (i * 14000 + 1)::BIGINT, 14000) AS text
      FROM documents, range(0, greatest((length(text) + 13999) // 14000, 1)) t(i)""",
    "section_full_text": """SELECT doc_id AS article_id, (greatest((length(text) + 13999) // 14000, 1) - 1)::BIGINT
      AS ext_text_count, text FROM documents""",
    "document_chunks_roundtrip": "SELECT doc_id AS article_id, TRUE AS same FROM documents",
    "unparsed_sections": """SELECT doc_id AS article_id, text FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "mark_sections_parsed": """SELECT doc_id AS article_id,
      CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'Y' END AS is_parsed FROM documents""",
    "strip_citations": r"""SELECT doc_id, len(regexp_extract_all(text, '\[\d+\]'))::BIGINT AS citations,
      regexp_replace(text, '\[\d+\]', '', 'g') AS text FROM documents""",
    "length_violations": """SELECT doc_id, 'text' AS column_name, length(text)::BIGINT AS length, 15000::BIGINT AS max_length
      FROM documents WHERE length(text) > 15000
      UNION ALL SELECT doc_id, 'source', length(source), 4 FROM documents WHERE length(source) > 4""",
    "section_rows": f"""{_S} SELECT article_id, title, section_id, 0::BIGINT AS ext_text_count,
      parent::BIGINT AS parent_section_id, ri::BIGINT AS row_idx, ci::BIGINT AS column_idx, rs::BIGINT AS row_span,
      cs::BIGINT AS column_span, tag, format, text FROM s""",
    "headings": f"""{_S} SELECT title, section_id, parent::BIGINT AS parent_section_id, tag, text FROM s
      WHERE tag IN ('HEADING', 'TITLE', 'SUBTITLE')""",
    "paragraphs": f"{_S} SELECT title, section_id, text FROM s WHERE tag = 'PARAGRAPH'",
    "list_items": f"""{_S} SELECT title, section_id, parent::BIGINT AS parent_section_id, format, text FROM s
      WHERE tag = 'LIST_ITEM'""",
    "table_cells": f"""{_S} SELECT title, ri::BIGINT AS row_idx, ci::BIGINT AS column_idx, rs::BIGINT AS row_span,
      cs::BIGINT AS column_span, format, text FROM s WHERE tag = 'TABLE_CELL'""",
    "format_spans": f"""{_A} SELECT title, 1::BIGINT AS section_id, 9::BIGINT AS start_pos,
      9 + length(c_name) AS end_pos, 'b' AS format, NULL AS link FROM a
      UNION ALL SELECT title, 1, 19 + length(c_name), 19 + length(c_name) + length(n_name), 'a', './' || n_name FROM a""",
    "link_filter": f"{_A} SELECT title, './' || n_name AS link FROM a",
    "boilerplate_removed": f"""{_A}, h AS ({_HTML}) SELECT title, 8 + 4 * n AS sections, 0::BIGINT AS boilerplate,
      len(string_split(html, 'id="References"')) - 1 AS in_html FROM a JOIN h USING (title)""",
    "section_children": f"""{_S} SELECT p.title, p.section_id, p.tag, count(*) AS children, max(x.section_id) AS last_child
      FROM s p JOIN s x ON x.title = p.title AND x.parent = p.section_id GROUP BY ALL""",
    "section_id_contiguity": f"{_A} SELECT title, 8 + 4 * n AS sections, TRUE AS contiguous FROM a",
    "page_links": """SELECT page_id, n, link FROM (
        SELECT page_id, unnest(l) AS link, unnest(range(len(l))) AS n
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))
      WHERE NOT starts_with(link, './File:') AND NOT contains(link, 'redlink=1')""",
    "page_section_counts": """SELECT page_id, len(regexp_extract_all(html, '<p[ >]'))::BIGINT AS paragraphs,
        len(regexp_extract_all(html, '<b>'))::BIGINT AS bold FROM pages""",
    "page_tag_counts": """SELECT tag, count(*) AS n,
        CASE WHEN tag IN ('h2','h3','h4','p','ul','ol','dl','li','dt','dd','table','th','td','a','b','strong','i','em',
          'blockquote','section','span','abbr','u','div','thead','tbody','tr','caption','body')
          THEN 'walked' ELSE 'dropped' END AS handling
      FROM (SELECT unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[ >]', 1)) AS tag FROM pages) GROUP BY tag""",
    "date_mentions": f"""{_M} SELECT title, section_id, start_pos, end_pos, date_text, NULL::BIGINT AS start_date,
      NULL::BIGINT AS end_date FROM m""",
    "event_sentences": f"{_M} SELECT title, section_id, start_pos, sentence AS display_text FROM m",
    "date_intervals": f"{_M} SELECT title, section_id, date_text, start_date, end_date, grain FROM m",
    "resolve_dates_article": f"{_chain('o_custkey')} SELECT * FROM z",
    "resolve_dates_in_two_runs": f"""{_chain('o_custkey')} SELECT article_id, section_id, start_pos, date_text, start_date, end_date, parse_status
      FROM z""",
    "event_flow_of_late_sections": f"""{_chain(_PAGES, _PAGES)} SELECT article_id, section_id,
        row_number() OVER (PARTITION BY article_id, section_id ORDER BY start_pos) AS n, date_text, start_date, end_date, parse_status
      FROM z WHERE date_text <> 'bad date'""",
    "resolve_dates_section": f"{_chain('o_custkey, o_orderkey % 3')} SELECT * FROM z",
    "unresolved_events": f"""{_chain('o_custkey')} SELECT article_id, section_id::BIGINT AS section_id, start_pos, date_text
      FROM q WHERE kind > 1""",
    "events_writeback": f"""{_chain('o_custkey')} SELECT article_id, section_id, start_pos, start_date, end_date,
      CASE WHEN parse_status = 1 THEN 1 END::BIGINT AS parse_status FROM z""",
    "date_failure_context": f"""{_chain('o_custkey')} SELECT article_id, section_id, start_pos, date_text,
      CASE WHEN section_id < 2 THEN c_name || ' section ' || section_id ELSE 'No context available' END AS context
      FROM z JOIN customer ON c_custkey = article_id WHERE parse_status = 2""",
    "articles_without_dates": f"""{_R} SELECT id, title, coalesce(n, 0) = 0 AS no_dates FROM art
      JOIN (SELECT article_id AS id, n FROM a) USING (id)""",
    "title_search": f"""{_R} SELECT * FROM ({_RESOLVED}) WHERE sub_title LIKE 'Alias Customer#%'
      ORDER BY sub_title LIMIT 50""",
    "title_search_wildcards": f"{_R} SELECT * FROM ({_RESOLVED}) WHERE sub_title LIKE '%stomer#%_7%'",
    "redirect_resolve": f"{_R} {_RESOLVED}",
    "title_search_ai_ci": "SELECT doc_id, lang FROM documents WHERE starts_with(strip_accents(lower(text)), 'el')",
    "title_search_folded": """SELECT prefix, doc_id, strip_accents(lower(text)) AS title_srch
      FROM documents, (VALUES ('Éa', 'ea'), ('th', 'th'), ('ÑA', 'na')) t(prefix, folded)
      WHERE starts_with(strip_accents(lower(text)), folded)""",
    "title_search_scripts": """SELECT prefix, p_partkey, folded || ' ' || lower(p_name) AS title_srch
      FROM part JOIN (VALUES (0, 'ors', 'orsted'), (1, 'LODZ', 'lodz'), (2, 'Aelf', 'aelfred'), (3, 'strass', 'strasse'), (4, 'ΑΘΗ', 'αθηνα'),
        (5, 'елк', 'елка'), (6, 'Do', 'do'), (7, 'čaca', 'cacak'), (8, 'йо', 'йод'), (9, 'ναισ', 'ναισ'), (10, 'OEU', 'oeuvre'),
        (11, 'izm', 'izmir'), (12, 'かな', 'かな'), (13, 'fin', 'finale'), (14, 'שלומ', 'שלומ'), (15, 'd ', 'd')) t(k, prefix, folded)
      ON p_partkey % 16 = k""",
    "title_token_search": r"""SELECT p_partkey, p_name, 2::BIGINT AS matched FROM part
      WHERE list_has_all(regexp_split_to_array(lower(p_name), '\W+'), ['ring', 'small'])""",
    "article_with_dump": f"""{_R} SELECT id, art.title, file_name FROM art JOIN a ON a.article_id = art.id""",
    "articles_to_parse": f"{_R} SELECT id, title FROM art WHERE id IS NOT NULL AND dump_idx % 4 <> 0",
    "refresh_articles": f"""{_R} SELECT id, art.title,
        CASE WHEN art.dump_idx % 4 = 0 THEN {_STATE.replace('dump_idx', 'art.dump_idx')} ELSE 'UP_TO_DATE' END AS err,
        CASE WHEN art.dump_idx % 4 = 0 THEN 1 ELSE 8 + 4 * n END::BIGINT AS sections,
        CASE WHEN art.dump_idx % 4 = 0 THEN 1 ELSE 0 END::BIGINT AS old_sections
      FROM art JOIN a ON a.article_id = art.id""",
    "article_detail": f"""{_with(_ORDERS, _ROWS, _SECTIONS, _MENTIONS)},
      ss AS (SELECT article_id, string_agg(section_id || ':' || tag || ':' || text, '|' ORDER BY section_id) AS sections
        FROM s GROUP BY 1),
      mm AS (SELECT article_id, string_agg(date_text, '|' ORDER BY section_id, start_pos) AS events FROM m GROUP BY 1)
      SELECT id, art.title, sections, 0::BIGINT AS ext_texts, 'b:9|a:' || (19 + length(c_name)) AS formats,
        coalesce(events, '') AS events
      FROM art JOIN a ON a.article_id = art.id JOIN ss ON ss.article_id = art.id LEFT JOIN mm ON mm.article_id = art.id""",
    "article_parse_stats": f"""{_A} SELECT article_id, 8 + 4 * n AS sections, 2::BIGINT AS formats, 2 * n AS events FROM a""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
                     "pages", "benchmark", "labels", "conversations")
    ),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
      GROUP BY ALL HAVING count(*) > 1""",
    "orphan_rows": """SELECT doc_id, lang FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "flagship": f"""{_M} SELECT title, count(*) AS events, min(start_date) AS first_date, max(end_date) AS last_date
      FROM m GROUP BY title""",
}

_RANKS = """x AS (SELECT dense_rank() OVER (ORDER BY file_name) AS f,
  row_number() OVER (PARTITION BY file_name ORDER BY dump_idx) - 1 AS i, title FROM a)"""

# Section, parent, tag, format, text, row, column, row span, column span of a rich page.
_RICH = """
  (0, NULL, 'HEADING', NULL, '@name', NULL, NULL, NULL, NULL), (1, 0, 'TITLE', NULL, 'Head of @key', NULL, NULL, NULL, NULL),
  (2, 0, 'PARAGRAPH', NULL, 'One two three @name', NULL, NULL, NULL, NULL), (3, 0, 'SUBTITLE', NULL, 'Sub', NULL, NULL, NULL, NULL),
  (4, 0, 'SUB_SUBTITLE', NULL, 'Deep', NULL, NULL, NULL, NULL), (5, 0, 'LIST', NULL, '', NULL, NULL, NULL, NULL),
  (6, 5, 'LIST_ITEM', 'li', 'after', NULL, NULL, NULL, NULL), (7, 6, 'LIST', NULL, '', NULL, NULL, NULL, NULL),
  (8, 7, 'LIST_ITEM', 'li', 'in @key', NULL, NULL, NULL, NULL), (9, 0, 'LIST', NULL, '', NULL, NULL, NULL, NULL),
  (10, 9, 'LIST_ITEM', 'dt', 'term', NULL, NULL, NULL, NULL), (11, 9, 'LIST_ITEM', 'dd', 'about @name', NULL, NULL, NULL, NULL),
  (12, 0, 'TABLE', NULL, '', NULL, NULL, NULL, NULL), (13, 12, 'TABLE_CELL', 'th', 'h', 0, 0, 2, 1),
  (14, 12, 'TABLE_CELL', 'td', 'b', 0, 1, 1, 3), (15, 14, 'TABLE', NULL, '', NULL, NULL, NULL, NULL),
  (16, 15, 'TABLE_CELL', 'td', 'in @key', 0, 0, 1, 1), (17, 12, 'TABLE_CELL', 'td', 'c', 1, 0, 1, 1),
  (18, 0, 'PARAGRAPH', NULL, '', NULL, NULL, NULL, NULL), (19, 0, 'PARAGRAPH', NULL, 'kept ab', NULL, NULL, NULL, NULL),
  (20, 0, 'PARAGRAPH', NULL, '@long', NULL, NULL, NULL, NULL), (21, 0, 'TITLE', NULL, 'Last', NULL, NULL, NULL, NULL)"""

_VIOLATIONS = {
    ("article", "repeated key"): "0",
    ("article", "too long"): "0",
    ("article_section", "repeated key"): "SELECT count(*) FROM a WHERE article_id % 5 = 0",
    # Sections of lines whose title an earlier line had taken.
    ("article_section", "no parent"): """SELECT sum(8 + 4 * n + (article_id % 5 = 0)::INT) FROM a
      WHERE article_id NOT IN (SELECT id FROM art WHERE id IS NOT NULL)""",
    ("article_section", "too long"): "0",
    ("article_section_ext_text", "repeated key"): "0",
    ("article_section_ext_text", "no parent"): "0",
    ("article_section_ext_text", "too long"): "0",
    ("article_section_format", "repeated key"): "0",
    ("article_section_format", "no parent"): "SELECT count(*) FROM a",
    ("article_section_format", "too long"): "0",
    ("parsed_event", "repeated key"): "0",
    ("parsed_event", "no parent"): "0",
    ("parsed_event", "too long"): "0",
}

ORACLES |= {
    "stream_ingest_parts": f"{_R}, {_RANKS} SELECT f * 4294967296 + i AS id, title FROM art JOIN x USING (title) WHERE id IS NOT NULL",
    "rich_sections": f"""WITH shape(section_id, parent, tag, format, text, ri, ci, rs, cs) AS (VALUES {_RICH})
      SELECT s_suppkey, section_id::BIGINT AS section_id, (section_id = 20)::BIGINT AS ext_text_count,
        parent::BIGINT AS parent_section_id, ri::BIGINT AS row_idx, ci::BIGINT AS column_idx, rs::BIGINT AS row_span,
        cs::BIGINT AS column_span, tag, format,
        CASE text WHEN '@long' THEN left(repeat('long ', 3000) || s_suppkey, 14000)
          ELSE replace(replace(text, '@name', s_name), '@key', s_suppkey::VARCHAR) END AS text
      FROM supplier, shape""",
    "section_paths": f"""WITH RECURSIVE shape(section_id, parent, tag, format, text, ri, ci, rs, cs) AS (VALUES {_RICH}),
      up AS (SELECT section_id, parent, 0 AS depth, section_id AS root, section_id::VARCHAR AS path FROM shape
        UNION ALL SELECT up.section_id, shape.parent, depth + 1, shape.section_id, shape.section_id || '/' || path FROM up JOIN shape ON up.parent = shape.section_id)
      SELECT s_suppkey, section_id::BIGINT AS section_id, depth::BIGINT AS depth, root::BIGINT AS root, path FROM supplier, up
      QUALIFY row_number() OVER (PARTITION BY s_suppkey, section_id ORDER BY depth DESC) = 1""",
    "rich_spans": """SELECT s_suppkey, 2::BIGINT AS section_id, ord::BIGINT AS ord, low::BIGINT AS start_pos,
        coalesce(high, 5 + length(s_name))::BIGINT AS end_pos, format
      FROM supplier, (VALUES (0, 4, 7, 'i'), (1, 8, 13, 'b'), (2, 0, NULL, 'blockquote')) t(ord, low, high, format)""",
    "rich_overflow": """SELECT s_suppkey, 20::BIGINT AS section_id, 1::BIGINT AS pieces,
      (1000 + length(s_suppkey::VARCHAR))::BIGINT AS longest, repeat('long ', 3000) || s_suppkey AS text FROM supplier""",
    "page_paragraphs": r"""WITH piece AS (
        SELECT page_id, unnest(range(1, len(p))) - 1 AS n, unnest(p[2:]) AS piece
        FROM (SELECT page_id, string_split_regex(regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>', '', 'g'), '<p(?: [^>]*)?>') AS p FROM pages)),
      cut AS (SELECT page_id, n, string_split_regex(piece, '</p>|</?(?:article|footer|div|h1|body|ul|nav)[ >]')[1] AS body FROM piece)
      SELECT page_id, n, replace(replace(replace(replace(replace(array_to_string(list_filter(list_transform(string_split_regex(body, '<[^>]*>'),
        lambda x: trim(x, E' \n\t\r\f')), lambda x: x <> ''), ' '), '–', '-'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text FROM cut""",
    "date_forms": """WITH q AS (
        SELECT o_orderkey AS article_id, o_orderkey % 8 AS kind, o_orderdate AS d, year(o_orderdate) AS y, month(o_orderdate) AS m,
          least(day(o_orderdate), 28) AS dd, o_orderkey % 900 + 1 AS small, o_orderkey % 30 + 1 AS cent FROM orders),
      f AS (SELECT *,
        CASE kind WHEN 0 THEN dd || strftime(d, ' %B ') || y || ' BC' WHEN 1 THEN strftime(d, '%b ') || dd || ', ' || y
          WHEN 2 THEN 'AD ' || small WHEN 3 THEN small || ' AD' WHEN 4 THEN y || '-' || (y + 3) WHEN 5 THEN cent || 'th century BC'
          WHEN 6 THEN strftime(d, '%B ') || y || ' BC' ELSE y || '000 BC' END AS date_text,
        CASE kind WHEN 0 THEN make_date(1 - y, m, dd) WHEN 1 THEN make_date(y, m, dd) WHEN 2 THEN make_date(small, 1, 1)
          WHEN 3 THEN make_date(small, 1, 1) WHEN 4 THEN make_date(y, 1, 1) WHEN 5 THEN make_date(1 - 100 * cent, 1, 1)
          WHEN 6 THEN make_date(1 - y, m, 1) ELSE make_date(1 - 1000 * y, 1, 1) END AS low,
        CASE kind WHEN 0 THEN make_date(1 - y, m, dd) + 1 WHEN 1 THEN make_date(y, m, dd) + 1
          WHEN 4 THEN make_date(y + 4, 1, 1) WHEN 5 THEN make_date(101 - 100 * cent, 1, 1)
          WHEN 6 THEN make_date(1 - y + m // 12, m % 12 + 1, 1) WHEN 7 THEN make_date(2 - 1000 * y, 1, 1)
          ELSE make_date(small + 1, 1, 1) END AS high,
        CASE kind WHEN 0 THEN 'day' WHEN 1 THEN 'day' WHEN 5 THEN 'century' WHEN 6 THEN 'month' ELSE 'year' END AS grain FROM q)
      SELECT article_id, (18 + 6 + 1 + length(article_id::VARCHAR) + 7)::BIGINT AS start_pos, date_text,
        'Order K' || article_id || ' is of ' || date_text || ', it says!' AS sentence,
        (datediff('day', DATE '1970-01-01', low::DATE) * 86400)::BIGINT AS start_date,
        (datediff('day', DATE '1970-01-01', high::DATE) * 86400 - 1)::BIGINT AS end_date, grain FROM f""",
    "date_forms_composed": """WITH q AS (
        SELECT o_orderkey AS article_id, o_orderkey % 8 AS kind, o_orderdate AS d, year(o_orderdate) AS y, month(o_orderdate) AS m,
          least(day(o_orderdate), 25) AS dd, least(month(o_orderdate), 11) AS m1, o_orderkey % 3 + 1 AS more, year(o_orderdate) // 10 * 10 AS dec FROM orders),
      o AS (SELECT *, dd || CASE WHEN dd IN (1, 21) THEN 'st' WHEN dd IN (2, 22) THEN 'nd' WHEN dd IN (3, 23) THEN 'rd' ELSE 'th' END AS th FROM q),
      f AS (SELECT *,
        CASE kind WHEN 0 THEN dd || '-' || (dd + more) || strftime(d, ' %B ') || y
          WHEN 1 THEN strftime(make_date(y, m1, 1), '%B') || ' to ' || strftime(make_date(y, m1 + 1, 1), '%B ') || y
          WHEN 2 THEN y || '/' || printf('%02d', (y + 1) % 100) WHEN 3 THEN th || ' of' || strftime(d, ' %B ') || y
          WHEN 4 THEN strftime(d, '%B ') || th || ', ' || y WHEN 5 THEN 'early ' || dec || 's' WHEN 6 THEN 'mid-' || dec || 's'
          ELSE 'late ' || dec || 's' END AS date_text,
        CASE kind WHEN 1 THEN make_date(y, m1, 1) WHEN 2 THEN make_date(y, 1, 1) WHEN 5 THEN make_date(dec, 1, 1)
          WHEN 6 THEN make_date(dec + 4, 1, 1) WHEN 7 THEN make_date(dec + 7, 1, 1) ELSE make_date(y, m, dd) END AS low,
        CASE kind WHEN 0 THEN make_date(y, m, dd + more) + 1 WHEN 1 THEN make_date(y, m1 + 1, 1) + INTERVAL 1 MONTH
          WHEN 2 THEN make_date(y + 2, 1, 1) WHEN 5 THEN make_date(dec + 4, 1, 1) WHEN 6 THEN make_date(dec + 7, 1, 1)
          WHEN 7 THEN make_date(dec + 10, 1, 1) ELSE make_date(y, m, dd) + 1 END AS high,
        CASE WHEN kind IN (0, 3, 4) THEN 'day' WHEN kind = 1 THEN 'month' ELSE 'year' END AS grain FROM o)
      SELECT article_id, (14 + length(article_id::VARCHAR))::BIGINT AS start_pos, date_text,
        (datediff('day', DATE '1970-01-01', low::DATE) * 86400)::BIGINT AS start_date,
        (datediff('day', DATE '1970-01-01', high::DATE) * 86400 - 1)::BIGINT AS end_date, grain FROM f""",
    "event_flow": f"""{_M} SELECT title, section_id, start_pos, date_text, start_date, end_date, 1::BIGINT AS parse_status,
      'Y' AS is_parsed FROM m""",
    "refresh_unparseable": f"""{_R} SELECT art.title, CASE WHEN art.dump_idx % 3 = 0 THEN 'UP_TO_DATE' ELSE 'PARSE_ERROR' END AS err,
        CASE WHEN art.dump_idx % 3 = 0 THEN 8 + 4 * n ELSE 1 END::BIGINT AS sections,
        CASE WHEN art.dump_idx % 3 = 0 THEN 0 ELSE 1 END::BIGINT AS old_sections
      FROM art JOIN a ON a.article_id = art.id""",
    "refresh_wanted": f"""{_R} SELECT art.title, CASE WHEN redirect IS NULL THEN 'NEW_DUMP' ELSE 'UP_TO_DATE' END AS err,
        CASE WHEN redirect IS NULL THEN 1 ELSE 8 + 4 * n END::BIGINT AS sections,
        CASE WHEN redirect IS NULL THEN 1 ELSE 0 END::BIGINT AS old_sections
      FROM art JOIN a ON a.article_id = art.id""",
    "article_detail_on_demand": f"""{_R} SELECT art.title, 'UP_TO_DATE' AS err,
        CASE WHEN redirect IS NULL THEN 1 ELSE 8 + 4 * n END::BIGINT AS sections,
        CASE WHEN redirect IS NULL THEN 'old' ELSE art.title END AS first_text
      FROM art JOIN a ON a.article_id = art.id WHERE description IS NOT NULL""",
    "stored_detail": f"""{_R} SELECT art.title, 'UP_TO_DATE' AS err, CASE WHEN redirect IS NULL THEN 1 ELSE 8 + 4 * n END::BIGINT AS sections
      FROM art JOIN a ON a.article_id = art.id WHERE a.dump_file_id = 1 ORDER BY a.dump_idx LIMIT 40""",
    "stored_violations": f"{_R} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{kind}' AS kind, coalesce(({sql if sql.startswith('SELECT') else 'SELECT ' + sql}), 0)::BIGINT AS n"
        for (t, kind), sql in _VIOLATIONS.items()
    ),
    "unresolved_batch": f"""{_chain('o_custkey')} SELECT article_id, section_id::BIGINT AS section_id, start_pos, date_text
      FROM q WHERE kind > 1 ORDER BY article_id, section_id, start_pos LIMIT 1000""",
    "articles_of_older_rules": f"{_R} SELECT id, title FROM art WHERE id IS NOT NULL AND dump_idx % 2 = 1",
}

# Pages hold paragraphs only: after the heading, one section each.
ORACLES["page_sections"] = f"""
  SELECT page_id, section_id::INT AS section_id, (greatest((length(text) + 13999) // 14000, 1) - 1)::INT AS ext_text_count,
    parent::INT AS parent_section_id, NULL::INT AS row_idx, NULL::INT AS column_idx, NULL::INT AS row_span, NULL::INT AS column_span,
    tag, NULL::VARCHAR AS format, left(text, 14000) AS text, NULL::VARCHAR AS is_parsed
  FROM (SELECT page_id, 0 AS section_id, NULL AS parent, 'HEADING' AS tag, url AS text FROM pages
    UNION ALL SELECT page_id, n + 1, 0, 'PARAGRAPH', text FROM ({ORACLES["page_paragraphs"]}))"""

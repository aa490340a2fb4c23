"""Article HTML to ordered sections and format spans.

Tag soup nests by a stack of open tags, which no join or window expresses, so the walk of
one document is a Python helper run over Arrow batches. Everything around it (JSON, dash
replacement, span explosion, chunking, joins) is native.
"""

from __future__ import annotations

import html.entities
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import article as fa
from ..functions import chunks
from ..schemas import BODY_JSON
from ..session import discard, stage

# Section types by tag, format spans by tag, tags without effect of their own.
HEADINGS = {"h2": "TITLE", "h3": "SUBTITLE", "h4": "SUB_SUBTITLE"}
BLOCKS = {
    "p": "PARAGRAPH", "ul": "LIST", "ol": "LIST", "dl": "LIST", "li": "LIST_ITEM", "dt": "LIST_ITEM",
    "dd": "LIST_ITEM", "table": "TABLE", "th": "TABLE_CELL", "td": "TABLE_CELL",
}
FORMATS = {"a": "a", "b": "b", "strong": "b", "i": "i", "em": "i", "blockquote": "blockquote"}
TRANSPARENT = {"section", "span", "abbr", "u", "div", "thead", "tbody"}
# Ids of headings whose section is dropped.
BOILERPLATE = ("References", "External_links", "Bibliography", "Citations")
# HTML void elements; elements whose text is not part of the page text.
VOID = set("area base basefont bgsound br col command embed frame hr image img input isindex keygen "
           "link menuitem meta nextid param source spacer track wbr".split())
UNREAD = {"script", "style", "template", "rt", "rp"}
KEPT_WHITESPACE = ("pre", "textarea")
ENDS_PARAGRAPH = {"p", "div", "section", "article", "ul", "ol", "dl", "table", "blockquote", "h1", "h2", "h3", "h4",
                  "h5", "h6", "footer", "nav"}

# Text without references followed by a plainly written tag. These make up almost all of a
# page and need none of the tokenizer's care; tags that switch its mode are left to it.
_PLAIN = re.compile(
    r"([^<&]*)<(?!(?:script|style|title|textarea|iframe|noembed|noframes|noscript|xmp|plaintext)\b)"
    r"(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z-]*=\"[^\"<>&]*\")*)(/?))>"
)
_ATTRIBUTE = re.compile(r" ([a-z-]+)=\"([^\"]*)\"")
# Inside of a plainly written tag after a NUL, as _walk_plain has it: tag (with the slash of an end tag), attributes, slash
# of an empty element. A title is plain, too, unless it holds tags.
_TAG = re.compile(
    r"\x00(?!(?:script|style|textarea|iframe|noembed|noframes|noscript|xmp|plaintext)\b)"
    r"(/[a-z][a-z0-9]*(?=$)|[a-z][a-z0-9]*)((?: [a-z][a-z-]*=\"[^\"<>&]*\")*)(/?)"
)
_ODD_TITLE = re.compile(r"<title\b(?!(?: [^<>/]*)?>[^<]*</title>)")
_SPACE = " \n\t\f\r"
_BOILERPLATE_IDS = [f'id="{name}"' for name in BOILERPLATE]
# Open elements up to which an end tag is looked for among them.
_DEEP = 200
# Tags kept as read, to be forgotten when there are more.
_KNOWN_TAGS = 10_000
# What a walk does at a start tag.
_FORMAT, _HEADING, _BLOCK, _MARK, _PASS, _VOID, _OTHER, _END = range(8)


def _character(name: str) -> str:
    """The character of a numeric reference; U+FFFD where there is none."""
    try:
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        if 0xD800 <= code < 0xE000:
            return "\N{REPLACEMENT CHARACTER}"
        return bytes([code]).decode("windows-1252") if code < 256 else chr(code)
    except UnicodeDecodeError:
        return chr(code)
    except (ValueError, OverflowError):
        return "\N{REPLACEMENT CHARACTER}"


class _Soup(HTMLParser):
    """Flat list of nodes in document order: ``[tag, attrs, end, parent]`` for elements,
    where ``end`` is the index after the subtree, and ``[None, text, end, parent]`` for text."""

    def __init__(self, implied_p_end: bool):
        super().__init__(convert_charrefs=False)
        self.implied_p_end = implied_p_end

    def updatepos(self, i, j):
        return j  # source positions are not needed

    def read(self, markup: str) -> list:
        self.reset()
        self.nodes, self.open, self.text = [], [], []
        self.depth = {}  # open elements by tag
        self.unread = 0  # open elements whose text is not page text
        position, size = 0, len(markup)
        while position < size:
            position = self._read_plain(markup, position)
            if position < size:
                position = self._feed_from(markup, position)
        self.close()
        self._flush()
        self._close_to(0)
        return self.nodes

    def _read_plain(self, markup: str, position: int) -> int:
        """The handlers below in one loop for plainly written tags, as calls would take most of the time; up to the
        first tag that is none."""
        nodes, opened, text, depth = self.nodes, self.open, self.text, self.depth
        for plain in iter(_PLAIN.scanner(markup, position).match, None):
            position = plain.end()
            before, closed, tag, attrs, empty = plain.groups()
            if text or (before and not before.strip(" \n\t\f\r")):
                text.append(before)
                self._flush()
            elif before and not self.unread:
                nodes.append([None, before, len(nodes) + 1, opened[-1] if opened else -1])
            if closed:
                if depth.get(closed):
                    if nodes[opened[-1]][0] == closed:
                        nodes[opened.pop()][2] = len(nodes)
                        depth[closed] -= 1
                        if closed in UNREAD:
                            self.unread -= 1
                    else:
                        self._close_tag(closed)
                continue
            if self.implied_p_end and tag in ENDS_PARAGRAPH:
                self._close_tag("p")
            n = len(nodes)
            node = [tag, dict(_ATTRIBUTE.findall(attrs)) if attrs else {}, n + 1, opened[-1] if opened else -1]
            nodes.append(node)
            if tag in VOID:
                continue
            opened.append(n)
            depth[tag] = depth.get(tag, 0) + 1
            if tag in UNREAD:
                self.unread += 1
            if empty:
                self._close_tag(tag)
        return position

    def _feed_from(self, markup: str, start: int) -> int:
        """Hand text to the tokenizer up to a ``<`` at which it has nothing left to read."""
        stop = start
        while True:
            # Growing steps, as what is left over is read again.
            start, stop = stop, markup.find("<", stop + 1 + len(self.rawdata))
            if stop < 0:
                self.feed(markup[start:])
                return len(markup)
            self.feed(markup[start:stop])
            if not self.rawdata and self.cdata_elem is None:
                return stop

    def _close_to(self, depth: int) -> None:
        end = len(self.nodes)
        for i in self.open[depth:]:
            node = self.nodes[i]
            node[2] = end
            self.depth[node[0]] -= 1
            if node[0] in UNREAD:
                self.unread -= 1
        del self.open[depth:]

    def _close_tag(self, tag: str) -> None:
        if not self.depth.get(tag):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]][0] == tag:
                self._close_to(depth)
                return

    def _flush(self, plain: bool = True) -> None:
        if not self.text:
            return
        text = "".join(self.text)
        self.text.clear()
        if not text.strip(" \n\t\f\r") and not any(self.depth.get(tag) for tag in KEPT_WHITESPACE):
            text = "\n" if "\n" in text else " "
        if plain and self.unread:
            return
        n = len(self.nodes)
        self.nodes.append([None, text, n + 1, self.open[-1] if self.open else -1])

    def handle_starttag(self, tag, attrs):
        self._flush()
        if self.implied_p_end and tag in ENDS_PARAGRAPH:
            self._close_tag("p")
        self.nodes.append([tag, {k: v or "" for k, v in attrs}, 0, self.open[-1] if self.open else -1])
        self.open.append(len(self.nodes) - 1)
        self.depth[tag] = self.depth.get(tag, 0) + 1
        if tag in UNREAD:
            self.unread += 1
        if tag in VOID:
            self._close_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_tag(tag)

    def handle_endtag(self, tag):
        self._flush()
        self._close_tag(tag)

    def handle_data(self, data):
        self.text.append(data)

    def handle_entityref(self, name):
        known = html.entities.html5
        self.text.append(known.get(name + ";") or known.get(name) or "&" + name)

    def handle_charref(self, name):
        self.text.append(_character(name))

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.text.append(data[6:])
            self._flush(plain=False)


def _cleared(nodes: list) -> set:
    """Sections emptied because they hold one of the boilerplate headings."""
    marked = [i for i, node in enumerate(nodes) if node[0] and node[1] and node[1].get("id") in BOILERPLATE]
    emptied: set[int] = set()
    for wanted in BOILERPLATE:
        for i in marked:
            if nodes[i][1]["id"] != wanted or any(e < i < nodes[e][2] for e in emptied):
                continue
            parent = nodes[i][3]
            while parent >= 0 and nodes[parent][0] != "section":
                parent = nodes[parent][3]
            if parent >= 0:
                emptied.add(parent)
            break
    return emptied


def _subtree_text(nodes: list, i: int, emptied: set) -> str:
    out, end = [], nodes[i][2]
    if end == i + 2 and nodes[i + 1][0] is None and i not in emptied:
        return nodes[i + 1][1].strip()  # nothing but text
    while i < end:
        node = nodes[i]
        if node[0] is None:
            out.append(node[1])
        i = node[2] if i in emptied else i + 1
    return "".join(out).strip()


def _span_count(attrs: dict, name: str) -> int:
    """The numeric attribute; 1 where it is no number or none that a column can hold."""
    value = attrs.get(name, "")
    if not value.isdecimal() or len(value) > 10:
        return 1
    number = int(value)
    return number if number < 1 << 31 else 1


def walk(nodes: list, title: str, extra_containers: frozenset = frozenset()) -> list:
    """Sections ``[parent, tag, format, text, row, column, row_span, column_span, spans]``.

    One text buffer serves the whole document. Opening a section empties it, closing one
    takes it; a span belongs to the section opened last.
    """
    sections = [[None, "HEADING", None, title, None, None, None, None, []]]
    body = next((i for i, n in enumerate(nodes) if n[0] == "body"), None)
    if body is None:
        return sections
    emptied = _cleared(nodes)
    transparent = TRANSPARENT | extra_containers
    buffer, length = [], 0  # pieces, and characters of all of them
    closing = []  # (end, tag, section, attrs), innermost last
    parents = [0]
    counters = [[0, 0]]  # row, column per table depth

    def append(text):
        nonlocal length
        if length and text:
            buffer.append(" ")
            length += 1
        start = length
        buffer.append(text)
        length += len(text)
        return start, length

    i, last = body + 1, nodes[body][2]
    if body in emptied:
        i = last
    while True:
        while closing and closing[-1][0] <= i:
            _, tag, section, attrs = closing.pop()
            if tag == "tr":
                counters[-1] = [counters[-1][0] + 1, 0]
                continue
            if tag != "caption":
                s = sections[section]
                s[3] = "".join(buffer)
                parents.pop()
                if tag in ("td", "th"):
                    s[4], s[5] = counters[-1]
                    s[6], s[7] = _span_count(attrs, "rowspan"), _span_count(attrs, "colspan")
                    counters[-1][1] += 1
                elif tag == "table":
                    counters.pop()
            buffer, length = [], 0
        if i >= last:
            return sections
        tag, attrs, end, _ = nodes[i]
        if tag is None:
            if not attrs.startswith("<span"):
                append(attrs.strip())
        elif tag in FORMATS:
            start, stop = append(_subtree_text(nodes, i, emptied))
            if tag != "a":
                sections[-1][8].append((start, stop, FORMATS[tag], None))
            elif "href" in attrs and not (attrs["href"].startswith(fa.FILE_LINK) or fa.MISSING_PAGE in attrs["href"]):
                sections[-1][8].append((start, stop, "a", attrs["href"]))
            i = end
            continue
        elif tag in HEADINGS:
            text = _subtree_text(nodes, i, emptied)
            sections.append([parents[-1], HEADINGS[tag], None, text, None, None, None, None, []])
            buffer, length = [], 0
            i = end
            continue
        elif tag in BLOCKS:
            kind = BLOCKS[tag]
            label = tag if kind in ("LIST_ITEM", "TABLE_CELL") else None
            sections.append([parents[-1], kind, label, None, None, None, None, None, []])
            buffer, length = [], 0
            if tag == "table":
                counters.append([0, 0])
            parents.append(len(sections) - 1)
            closing.append((end, tag, len(sections) - 1, attrs))
        elif tag == "tr" or tag == "caption":
            closing.append((end, tag, None, attrs))
        elif tag not in transparent or i in emptied:
            i = end
            continue
        i += 1


class _Columns:
    """Sections and spans of many pages, column by column. Spans belong to the section opened last, so they come in
    the order of the sections, and a section has those from its ``first_span`` on."""

    def __init__(self):
        self.sections = tuple([] for _ in range(9))  # parent, tag, format, text, row, column, row_span, column_span, first_span
        self.spans = tuple([] for _ in range(4))  # start, end, format, link

    def size(self) -> tuple[int, int]:
        return len(self.sections[0]), len(self.spans[0])

    def cut(self, size: tuple[int, int]) -> None:
        for column in self.sections:
            del column[size[0] :]
        for column in self.spans:
            del column[size[1] :]

    def extend(self, walked: list) -> None:
        """Add what :func:`walk` returns."""
        for section in walked:
            for column, value in zip(self.sections, (*section[:8], len(self.spans[0]))):
                column.append(value)
            for span in section[8]:
                for column, value in zip(self.spans, span):
                    column.append(value)


def _actions(extra_containers: frozenset) -> dict[str, int]:
    found = {tag: _PASS for tag in TRANSPARENT | extra_containers} | {tag: _MARK for tag in ("tr", "caption")}
    found |= {tag: _BLOCK for tag in BLOCKS} | {tag: _HEADING for tag in HEADINGS} | {tag: _FORMAT for tag in FORMATS}
    return found | {tag: _VOID for tag in VOID}


def _read_tag(raw: str, actions: dict[str, int]) -> tuple | None:
    """``(tag, action, attributes, empty, boilerplate id)`` of a plain tag that :func:`_walk_plain` reads; None for others."""
    plain = _TAG.fullmatch(raw)
    if plain is None:
        return None
    name, attrs, empty = plain.groups()
    if name[0] == "/":
        return name[1:], _END, None, False, False
    if name in UNREAD or name in KEPT_WHITESPACE:
        return None
    found = dict(_ATTRIBUTE.findall(attrs)) if attrs else {}
    return name, actions.get(name, _OTHER), found, bool(empty), found.get("id") in BOILERPLATE


def _walk_plain(page: str, title: str, actions: dict[str, int], known: dict[str, tuple], out: _Columns) -> bool:
    """Tokenizer and :func:`walk` in one loop, without nodes, for pages that consist of plain tags and text without
    references: almost all of the time goes into calls, matches and nodes otherwise. False, with nothing added, for any
    other page. ``known`` keeps tags as they were read.
    """
    if "&" in page or "\0" in page or _ODD_TITLE.search(page):
        return False
    # Text and tags by turns. Each tag has to begin with the NUL that stands for its "<", and each "<" has to be that of a tag.
    pieces = page.replace("<", ">\0").split(">")
    if len(pieces) != 2 * page.count("<") + 1:
        return False
    if any([page.count(name) > 1 for name in _BOILERPLATE_IDS]):
        return False  # which of them counts depends on the others
    start = out.size()
    parent_of, tags, labels, texts, rows, columns, row_spans, column_spans, first_spans = out.sections
    span_starts, span_ends, span_formats, span_links = out.spans
    base = start[0]

    def section(parent, tag, label, text):
        parent_of.append(parent)
        tags.append(tag)
        labels.append(label)
        texts.append(text)
        rows.append(None)
        columns.append(None)
        row_spans.append(None)
        column_spans.append(None)
        first_spans.append(len(span_starts))

    section(None, "HEADING", None, title)
    # Open elements and what their end does: the section of a block, or the tag of another one. Outside the body, in a
    # dropped subtree and in one that is read as text, nothing is done until ``opened`` is back at ``limit``.
    opened, ends = [], []
    outside, reading, dropping, taking = 0, 1, 2, 3
    mode, limit, body = outside, -1, -1
    taken, taken_tag, taken_attrs = [], "", {}
    buffer, length = [], 0
    parents, counters = [0], [[0, 0]]
    before_sections = {}  # state at the start of an open <section>, by its depth

    # Text after the last tag is outside of the body, or in an element without an end.
    for before, raw in zip(pieces[::2], pieces[1::2]):
        if before:
            if mode == reading:
                before = before.strip()
                if before:
                    if length:
                        buffer.append(" ")
                        length += 1
                    buffer.append(before)
                    length += len(before)
            elif mode == taking:
                taken.append(before if before.strip(_SPACE) else "\n" if "\n" in before else " ")
        tag = known.get(raw)
        if tag is None:
            tag = _read_tag(raw, actions)
            if tag is None:
                out.cut(start)
                return False
            if len(known) >= _KNOWN_TAGS:
                known.clear()
            known[raw] = tag
        closed, action, attrs, empty, marked = tag
        if action != _END:
            if marked and "section" in opened:
                depth = len(opened) - 1 - opened[::-1].index("section")
                if depth <= body or body < 0:
                    out.cut(start)
                    return False  # emptied around the body, which has no effect but on other headings
                if mode == reading or depth < limit:
                    size, buffer, n_buffer, length, n_parents, n_counters, counter = before_sections[depth]
                    out.cut(size)
                    del buffer[n_buffer:], parents[n_parents:], counters[n_counters:]
                    counters[-1] = list(counter)
                    mode, limit = dropping, depth
                elif mode == taking:
                    out.cut(start)
                    return False
            if action == _VOID:
                continue
            end = None
            if mode == reading:
                if action == _BLOCK:
                    end = len(tags) - base
                    kind = BLOCKS[closed]
                    section(parents[-1], kind, closed if kind == "LIST_ITEM" or kind == "TABLE_CELL" else None, None)
                    buffer, length = [], 0
                    if closed == "table":
                        counters.append([0, 0])
                    elif kind == "TABLE_CELL":
                        end = (end, attrs)
                    parents.append(len(tags) - 1 - base)
                elif action == _PASS:
                    if closed == "section":
                        before_sections[len(opened)] = (out.size(), buffer, len(buffer), length, len(parents), len(counters), tuple(counters[-1]))
                elif action == _MARK:
                    end = closed
                elif action == _OTHER:
                    mode, limit = dropping, len(opened)
                else:
                    mode, limit = taking, len(opened)
                    taken, taken_tag, taken_attrs = [], closed, attrs
            elif mode == outside and closed == "body":
                mode, body = reading, len(opened)
            opened.append(closed)
            ends.append(end)
            if not empty:
                continue
        if not opened:
            continue
        if opened[-1] != closed:
            if len(opened) > _DEEP:
                out.cut(start)
                return False
            if closed not in opened:
                continue
        while True:
            name, end = opened.pop(), ends.pop()
            if mode == reading:
                if end is None:
                    if len(opened) == body:
                        return True
                elif end == "tr":
                    counters[-1] = [counters[-1][0] + 1, 0]
                else:
                    if end != "caption":
                        parents.pop()
                        text = "".join(buffer)
                        if name == "table":
                            counters.pop()
                            texts[base + end] = text
                        elif end.__class__ is tuple:
                            end, found = end
                            at = base + end
                            texts[at] = text
                            rows[at], columns[at] = counters[-1]
                            row_spans[at], column_spans[at] = (_span_count(found, "rowspan"), _span_count(found, "colspan")) if found else (1, 1)
                            counters[-1][1] += 1
                        else:
                            texts[base + end] = text
                    buffer, length = [], 0
            elif len(opened) == limit:
                if mode == taking:
                    text = "".join(taken).strip()
                    if taken_tag in HEADINGS:
                        section(parents[-1], HEADINGS[taken_tag], None, text)
                        buffer, length = [], 0
                    else:
                        if length and text:
                            buffer.append(" ")
                            length += 1
                        found = length
                        buffer.append(text)
                        length += len(text)
                        link = taken_attrs.get("href") if taken_tag == "a" else None
                        if taken_tag != "a" or not (link is None or link.startswith(fa.FILE_LINK) or fa.MISSING_PAGE in link):
                            span_starts.append(found)
                            span_ends.append(length)
                            span_formats.append(FORMATS[taken_tag])
                            span_links.append(link)
                mode, limit = reading, -1
            if name == closed:
                break
    if body >= 0 and opened:
        # Elements without an end: the other path closes them where the page ends.
        out.cut(start)
        return False
    return True


_PARSED = (
    "section_id int, parent_section_id int, tag string, format string, text string, row_idx int, "
    "column_idx int, row_span int, column_span int, parse_error boolean, "
    "spans array<struct<start_pos:int,end_pos:int,format:string,link:string>>"
)
_TYPES = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
_SPAN_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.string()]


def _walker(n_keys: int, names: list[str], extra_containers: frozenset, implied_p_end: bool):
    actions = _actions(extra_containers)

    def run(batches):
        known = {}
        soup = _Soup(implied_p_end)
        for batch in batches:
            out, stops, errors = _Columns(), [], []
            titles, pages = batch.column(n_keys).to_pylist(), batch.column(n_keys + 1).to_pylist()
            for title, page in zip(titles, pages):
                failed, before = False, out.size()
                try:
                    if implied_p_end or not _walk_plain(page or "", title, actions, known, out):
                        out.extend(walk(soup.read(page or ""), title, extra_containers))
                except Exception:  # any page that cannot be walked is marked; the job goes on
                    out.cut(before)
                    soup = _Soup(implied_p_end)
                    out.extend(walk([], title))
                    failed = True
                stops.append(len(out.sections[0]))
                errors.append(failed)
            counts = np.diff(np.array(stops, np.int64), prepend=0)
            total = int(counts.sum())
            picks = np.repeat(np.arange(len(counts)), counts)
            ids = np.arange(total) - np.repeat(np.array(stops, np.int64) - counts, counts)
            taken = pa.array(picks, pa.int64())
            keys = [batch.column(k).take(taken) for k in range(n_keys)]
            parent, tag, fmt, text, row_idx, column_idx, row_span, column_span = [
                pa.array(c, t) for c, t in zip(out.sections, _TYPES)
            ]
            span_struct = pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(out.spans, _SPAN_TYPES)], names=["start_pos", "end_pos", "format", "link"]
            )
            offsets = pa.array([*out.sections[8], len(out.spans[0])], pa.int32())
            yield pa.RecordBatch.from_arrays(
                keys
                + [pa.array(ids, pa.int32()), parent, tag, fmt, text, row_idx, column_idx, row_span, column_span]
                + [pa.array(np.array(errors, bool)[picks]), pa.ListArray.from_arrays(offsets, span_struct)],
                names=names,
            )

    return run


def parse_sections(
    pages: DataFrame, keys: list[str], title: str = "title", html_col: str = "html",
    extra_containers=(), implied_p_end: bool = False,
) -> DataFrame:
    """One row per section with its full text and its format spans; no shuffle.

    ``keys`` are carried through. Links to files and missing pages are not among the spans.
    """
    clean = pages.select(
        *keys, F.col(title).alias("_title"), fa.hyphenate_dashes(F.col(html_col)).alias("_html")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in clean.schema.fields[: len(keys)]]
    names = list(keys) + [c.split(" ", 1)[0] for c in _PARSED.replace(", ", "\n").split("\n")]
    run = _walker(len(keys), names, frozenset(extra_containers), implied_p_end)
    return clean.mapInArrow(run, ", ".join(fields + [_PARSED]))


def article_pages(lines: DataFrame) -> DataFrame:
    """``(article_id, title, html)`` of dump lines that can be parsed."""
    document = lines.withColumn("j", F.from_json("value", BODY_JSON, {"columnNameOfCorruptRecord": "_corrupt"}))
    page = F.struct(
        fa.article_id(F.col("dump_file_id"), F.col("dump_idx")).alias("article_id"),
        F.col("j.name").alias("title"),
        F.col("j.article_body.html").alias("html"),
    )
    usable = F.col("j._corrupt").isNull() & F.col("j.name").isNotNull() & F.col("j.article_body.html").isNotNull()
    # Through an array so that the test is not pushed below the JSON parse and run twice.
    return document.select(F.inline(F.when(usable, F.array(page))))


def parse_articles(lines: DataFrame) -> DataFrame:
    """The section job over dump lines, keyed by ``article_id`` and ``title``."""
    return parse_sections(article_pages(lines), ["article_id", "title"])


def section_rows(parsed: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Rows of ``article_section`` plus the ``overflow`` pieces."""
    split = chunks.split_overflow(parsed)
    return split.select(
        *keys, "section_id", "ext_text_count", "parent_section_id", "row_idx", "column_idx", "row_span",
        "column_span", "tag", "format", "text", F.lit(None).cast("string").alias("is_parsed"), "overflow",
    )


def article_section(parsed: DataFrame) -> DataFrame:
    return section_rows(parsed).drop("overflow")


def article_section_ext_text(parsed: DataFrame) -> DataFrame:
    return chunks.overflow_rows(section_rows(parsed), ["article_id", "section_id"])


def format_spans(parsed: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    return parsed.select(*keys, "section_id", F.posexplode("spans").alias("ord", "s")).select(
        *keys, "section_id", "ord", "s.start_pos", "s.end_pos", "s.format", "s.link"
    )


def article_section_format(parsed: DataFrame) -> DataFrame:
    """Rows of ``article_section_format``; the key is the span's place: article, section, ordinal."""
    return format_spans(parsed)


def section_children(sections: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Parent to child edges of the section tree, with both tags."""
    keys = list(keys)
    child = sections.where("parent_section_id is not null").select(
        *keys, F.col("parent_section_id").alias("section_id"), F.col("section_id").alias("child_id"),
        F.col("tag").alias("child_tag"),
    )
    return sections.select(*keys, "section_id", "tag").join(child, [*keys, "section_id"])


def section_paths(sections: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """``keys, section_id, depth, root, path`` of every section: how many sections lie above it, the topmost
    of them, and all from there down to it. A parent that is no section ends the path.

    Every round joins each section with the one its path hangs from, so paths double: a tree of depth n takes
    about log2(n) joins of narrow rows, and no article is gathered in one task.
    """
    up = F.col("parent_section_id")
    paths = stage(sections.select(*keys, "section_id", up.alias("up"), F.array("section_id").alias("path")), "paths")
    while paths.where("up is not null").take(1):
        if paths.where(F.array_contains("path", F.col("up"))).take(1):
            raise ValueError("sections are their own ancestors")
        above = paths.select(*keys, F.col("section_id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        joined = paths.join(above, [*keys, "up"], "left")
        longer = joined.select(*keys, "section_id", F.col("_up").alias("up"), F.concat(F.coalesce("_path", F.slice("path", 1, 0)), "path").alias("path"))
        after = stage(longer, "paths")
        discard(paths)
        paths = after
    return paths.select(*keys, "section_id", (F.size("path") - 1).alias("depth"), F.get("path", F.lit(0)).alias("root"), "path")

"""Golden rows for the HTML walk, worked out by hand from the rules."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from articlelake.operators import sections
from articlelake.operators.sections import BODY_JSON, _Soup, article_section_ext_text, parse_articles, parse_sections, walk


def run(html, title="T", wrap=True, **options):
    implied = options.pop("implied_p_end", False)
    page = f"<html><body>{html}</body></html>" if wrap else html
    return walk(_Soup(implied).read(page), title, frozenset(options.pop("extra_containers", ())))


def brief(sections):
    """(parent, tag, text) of all but the heading."""
    return [(s[0], s[1], s[3]) for s in sections[1:]]


def test_heading_and_missing_body():
    assert run("<p>x</p>", wrap=False) == [[None, "HEADING", None, "T", None, None, None, None, []]]
    assert run("")[0][3] == "T"


def test_paragraph_joins_text_with_single_spaces():
    (_, p) = run("<p>  one <b>two</b>, <span>three</span>\n</p>")
    assert p[3] == "one two , three"
    assert p[8] == [(4, 7, "b", None)]


def test_headings_hang_under_the_enclosing_section():
    got = brief(run("<section><h2>A <i>b</i></h2><p>x</p><h3>C</h3><h4>D</h4></section>"))
    assert got == [(0, "TITLE", "A b"), (0, "PARAGRAPH", "x"), (0, "SUBTITLE", "C"), (0, "SUB_SUBTITLE", "D")]


def test_text_before_a_nested_list_is_lost_and_text_after_is_kept():
    got = run("<ul><li>lost <ul><li>inner</li></ul> after <b>bold</b></li></ul>")
    assert brief(got) == [(0, "LIST", ""), (1, "LIST_ITEM", "after bold"), (2, "LIST", ""), (3, "LIST_ITEM", "inner")]
    # The span stands in the text of item 2 but belongs to the section opened last.
    assert got[4][8] == [(6, 10, "b", None)]
    assert got[2][8] == []


def test_definition_list():
    got = run("<dl><dt>term</dt><dd>text</dd></dl>")
    assert [(s[1], s[2], s[3]) for s in got[1:]] == [("LIST", None, ""), ("LIST_ITEM", "dt", "term"), ("LIST_ITEM", "dd", "text")]


def test_table_coordinates_and_spans():
    got = run(
        '<table><caption>gone</caption><thead><tr><th colspan="2">a</th><th>b</th></tr></thead>'
        '<tbody><tr><td rowspan="x">c</td><td rowspan="3">d</td></tr></tbody><tfoot><tr><td>gone</td></tr></tfoot></table>'
    )
    cells = [(s[2], s[3], *s[4:8]) for s in got if s[1] == "TABLE_CELL"]
    assert cells == [("th", "a", 0, 0, 1, 2), ("th", "b", 0, 1, 1, 1), ("td", "c", 1, 0, 1, 1), ("td", "d", 1, 1, 3, 1)]
    assert brief(got)[0] == (0, "TABLE", "")


def test_nested_table_has_its_own_counters():
    got = run("<table><tr><td>a</td><td>x<table><tr><td>i</td></tr><tr><td>j</td></tr></table></td></tr><tr><td>z</td></tr></table>")
    cells = [(s[3], s[4], s[5]) for s in got if s[1] == "TABLE_CELL"]
    assert cells == [("a", 0, 0), ("", 0, 1), ("i", 0, 0), ("j", 1, 0), ("z", 1, 0)]


def test_cells_outside_a_table_use_outer_counters():
    got = run("<tr><td>a</td></tr><td>b</td>")
    assert [(s[3], s[4], s[5]) for s in got[1:]] == [("a", 0, 0), ("b", 1, 0)]


@pytest.mark.parametrize("tag", ["h1", "h5", "sup", "figure", "article", "main", "nav", "footer", "tfoot", "cite"])
def test_other_tags_drop_their_subtree(tag):
    assert brief(run(f"<p>a<{tag}>no <b>no</b></{tag}>b</p>")) == [(0, "PARAGRAPH", "a b")]


def test_transparent_tags():
    assert brief(run("<div><p>a <abbr>b</abbr> <u>c</u></p></div>")) == [(0, "PARAGRAPH", "a b c")]


def test_nested_format_loses_the_inner_one():
    (_, p) = run('<p><b>x <a href="./L">y</a></b> <em>e</em> <strong>s</strong></p>')
    assert p[3] == "x y e s"
    assert p[8] == [(0, 3, "b", None), (4, 5, "i", None), (6, 7, "b", None)]


def test_links():
    (_, p) = run('<p><a href="./A">a</a><a href="./File:x">f</a><a href="./B?redlink=1">r</a><a>n</a><a href="">e</a></p>')
    assert p[3] == "a f r n e"
    assert p[8] == [(0, 1, "a", "./A"), (8, 9, "a", "")]


def test_empty_span_has_equal_ends():
    (_, p) = run("<p>ab<b> </b>c</p>")
    assert p[3] == "ab c"
    assert p[8] == [(2, 2, "b", None)]


def test_blockquote_is_a_span_of_the_last_section():
    got = run("<p>a</p><blockquote>quoted <b>text</b></blockquote>")
    assert brief(got) == [(0, "PARAGRAPH", "a")]
    assert got[1][8] == [(0, 11, "blockquote", None)]


def test_comments_and_text_that_starts_like_a_span():
    assert brief(run("<p>a<!-- no -->b&lt;span c</p>")) == [(0, "PARAGRAPH", "a b<span c")]
    assert brief(run("<p>a<i></i>&lt;span c</p>")) == [(0, "PARAGRAPH", "a")]


def test_whitespace_nodes_collapse_inside_formats():
    (_, p) = run("<p><b>a<u> \t </u>b<u> \n </u>c</b></p>")
    assert p[3] == "a b\nc"


def test_entities():
    assert brief(run("<p>&eacute;&#233;&#x41;&#146;&nosuch;&amp;</p>")) == [(0, "PARAGRAPH", "éA’".replace("é", "éé") + "&nosuch&")]


def test_script_text_is_never_text():
    (_, p) = run("<p><b>a<script>var x = '</p>';</script>b</b></p>")
    assert p[3] == "ab"


def test_unclosed_tags_nest_and_end_tags_close_to_the_nearest():
    got = brief(run("<p>a<p>b</p>c"))
    assert got == [(0, "PARAGRAPH", "c"), (1, "PARAGRAPH", "b")]
    assert brief(run("<p>a<p>b</p>c", implied_p_end=True)) == [(0, "PARAGRAPH", "a"), (0, "PARAGRAPH", "b")]
    assert brief(run("<p>a</i></b>b</p>")) == [(0, "PARAGRAPH", "a b".replace(" ", " "))]


def test_void_and_self_closing_tags():
    assert brief(run("<p>a<br>b<br/>c</br>d<img src=x>e</p>")) == [(0, "PARAGRAPH", "a b c d e")]
    assert brief(run("<p/>x<p>y</p>")) == [(0, "PARAGRAPH", ""), (0, "PARAGRAPH", "y")]


def test_boilerplate_sections_are_emptied():
    html = (
        '<section><p>keep</p></section><section><h2 id="References">R</h2><p>no</p><section><p>no</p></section></section>'
        '<section><p>outer</p><section><h2 id="External_links">E</h2></section><p>still</p></section>'
    )
    assert brief(run(html)) == [(0, "PARAGRAPH", "keep"), (0, "PARAGRAPH", "outer"), (0, "PARAGRAPH", "still")]


def test_boilerplate_outside_any_section_stays():
    assert brief(run('<h2 id="References">R</h2>')) == [(0, "TITLE", "R")]


def test_boilerplate_search_skips_emptied_sections():
    html = (
        '<section><h2 id="External_links">E</h2><h2 id="References">R</h2></section>'
        '<section><h2 id="External_links">F</h2><p>no</p></section><p>end</p>'
    )
    assert brief(run(html)) == [(0, "PARAGRAPH", "end")]


def test_extra_containers():
    assert brief(run("<article><p>a</p></article>", extra_containers=("article",))) == [(0, "PARAGRAPH", "a")]


def test_deep_nesting_is_not_recursive():
    (_, p) = run("<p>" + "<span>" * 5000 + "x")
    assert p[3] == "x"


PIECES = [
    "<p>", "</p>", "<b>", "</b>", '<a href="./X">', "</a>", "<br>", "<br/>", "text", " ", "\n", "&amp;", "&", "&eacute", ";",
    "&#65", "&#x42;", "<", ">", "<!-- c <p> -->", "<!--", "-->", "<script>", "</script>", "var a='<b>'", "<style>x</style>",
    "<title>t</title>", "<UL>", "</ul>", "<li class=x>", "<td colspan='2'>", '<a title="a<b">', "<![CDATA[x]]>", "<!DOCTYPE html>",
    "<?pi?>", '"', "<pre>", "</pre>", "<p/>", "</", "<a href>", '<i id="References">', "<rt>", "</rt >", "<x-y>", "é",
]


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25))
def test_plain_tags_read_like_the_tokenizer(pieces):
    markup = "".join(pieces)

    class Slow(_Soup):
        def read(self, text):
            self.reset()
            self.nodes, self.open, self.text, self.depth, self.unread = [], [], [], {}, 0
            self.feed(text)
            self.close()
            self._flush()
            self._close_to(0)
            return self.nodes

    def outcome(soup):
        try:
            return soup.read(markup)
        except AssertionError:
            return "refused"

    assert outcome(_Soup(False)) == outcome(Slow(False))


def test_parse_job_and_errors(spark):
    pages = spark.createDataFrame(
        [(1, "A", "<body><p>x – y</p></body>"), (2, "B", "<body><![bad[ x"), (3, "C", None)], "id int, title string, html string"
    )
    rows = parse_sections(pages, ["id"]).orderBy("id", "section_id").collect()
    assert [(r.id, r.section_id, r.tag, r.text, r.parse_error) for r in rows] == [
        (1, 0, "HEADING", "A", False),
        (1, 1, "PARAGRAPH", "x - y", False),
        (2, 0, "HEADING", "B", True),
        (3, 0, "HEADING", "C", False),
    ]


def test_spans_point_into_the_text(spark, sf):
    from articlelake.plans import corpus

    parsed = parse_articles(corpus.lines(spark, sf)).where("tag = 'PARAGRAPH'")
    for r in parsed.limit(20).collect():
        for s in r.spans:
            assert r.text[s.start_pos : s.end_pos] in ("NATION", r.title, s.link and s.link[2:])


def test_long_section_overflows(spark):
    lines = spark.createDataFrame([(1, 0, "x" * 30000)], "dump_file_id bigint, dump_idx bigint, body string").selectExpr(
        "dump_file_id", "dump_idx",
        """to_json(struct('L' as name, 'u' as url, struct('<body><p>' || body || '</p></body>' as html) as article_body)) as value""",
    )
    rows = article_section_ext_text(parse_articles(lines)).orderBy("count_id").collect()
    assert [(r.section_id, r.count_id, len(r.text)) for r in rows] == [(1, 0, 14000), (1, 1, 2000)]
    assert "html" in BODY_JSON


@pytest.mark.parametrize(
    "markup, text",
    [("&#xD800;a", "\ufffda"), ("&#57343;", "\ufffd"), ("&#" + "9" * 5000 + ";b", "\ufffdb"), ("&#x110000;", "\ufffd"), ("&#0;c", "\x00c")],
)
def test_odd_references_become_replacement_characters(markup, text):
    assert run(f"<p>{markup}</p>")[1][3] == text


@pytest.mark.parametrize("value", ["99999999999", "9" * 6000, "2147483648", "-1", "x", ""])
def test_span_numbers_that_do_not_fit_are_one(value):
    cell = next(s for s in run(f'<table><tr><td colspan="{value}" rowspan="2147483647">a</td></tr></table>') if s[1] == "TABLE_CELL")
    assert cell[6:8] == [2147483647, 1]


def test_a_bad_page_does_not_fail_the_job(spark):
    pages = ["<body><p>good</p></body>", "<body><![x[", "<body><p>&#xD800;</p></body>", '<body><table><tr><td colspan="99999999999">x</td></tr></table></body>', None]
    frame = spark.createDataFrame(list(enumerate(pages)), "id long, html string").selectExpr("id", "html", "'t' as title")
    rows = parse_sections(frame, ["id"]).collect()
    assert {r.id for r in rows} == set(range(5)) and {r.id for r in rows if r.parse_error} == {1}


def test_any_failure_is_marked_on_its_own_page(spark):
    """The walk recurses nowhere and trusts nothing: even a failure it does not expect stays with its page."""
    deep = "<body>" + "<div>" * 50_000 + "x" + "</div>" * 50_000 + "</body>"
    frame = spark.createDataFrame([(1, deep), (2, "<body><p>b</p></body>")], "id long, html string").selectExpr("id", "html", "'t' as title")
    assert {r.id: r.text for r in parse_sections(frame, ["id"]).where("tag <> 'HEADING'").collect()} == {2: "b"}


def test_long_paragraphs_take_linear_time():
    import time

    page = "<p>" + "word <span>of</span> text " * 250_000 + "</p>"
    assert len(page) > 5_000_000
    start = time.process_time()
    (_, p) = run(page)
    assert time.process_time() - start < 10 and len(p[3]) > 3_000_000


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet='<>/&#xD8;"= \'ptdhra0129col!-[]', max_size=80))
def test_odd_markup_gives_storable_rows(markup):
    for s in run(markup):
        s[3].encode()
        assert all(x is None or x < 1 << 31 for x in s[4:8])


def test_section_paths(spark):
    """Long chains, several trees, parents that are no section, and articles that share section numbers."""
    from articlelake.operators.sections import section_paths

    rows = [(1, i, i - 1 if i else None) for i in range(40)] + [(2, 0, None), (2, 1, 0), (2, 2, 0), (2, 3, 2), (2, 4, 99), (2, 5, 4)]
    df = spark.createDataFrame(rows, "article_id long, section_id int, parent_section_id int")
    got = {(r.article_id, r.section_id): (r.depth, r.root, r.path) for r in section_paths(df).collect()}
    assert len(got) == len(rows) and got[1, 39] == (39, 0, list(range(40)))
    assert got[2, 3] == (2, 0, [0, 2, 3]) and got[2, 4] == (0, 4, [4]) and got[2, 5] == (1, 4, [4, 5]) and got[2, 0] == (0, 0, [0])
    assert section_paths(df.limit(0)).count() == 0
    ring = spark.createDataFrame([(1, 0, 1), (1, 1, 0)], "article_id long, section_id int, parent_section_id int")
    with pytest.raises(ValueError):
        section_paths(ring)


def test_runs_of_plain_tags_read_like_single_ones(monkeypatch):
    """Taking a run of plainly written tags apart in one call gives the nodes that the tokenizer's handlers give."""
    rng = random.Random(11)
    pieces = ["<p>", "</p>", "<b>", "</b>", '<a href="./x">', "</a>", "<br>", "<br/>", "<div/>", "<rt>", "</rt>", "<template>", "</template>", "<pre>", "</pre>",
              "<ul>", "<li>", "</ul>", '<td colspan="2">', "<table>", "</table>", " ", "\n", " \n ", "word", "&amp;", "<!-- c -->", "<title>t</title>", "</x>", "<"]
    pages = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(3000)]
    for implied in (False, True):
        soup = sections._Soup(implied)
        handled = []
        monkeypatch.setattr(sections._Soup, "handle_starttag", lambda self, tag, attrs, call=sections._Soup.handle_starttag: (handled.append(tag), call(self, tag, attrs))[1])
        assert soup.read("<body><p>one <b>two</b></p><br></body>") and not handled
        found = [soup.read(page) for page in pages]
        with monkeypatch.context() as patch:
            patch.setattr(sections, "_PLAIN", re.compile(r"(?!)"))
            assert found == [soup.read(page) for page in pages]


def columns_of(page, extra=()):
    """What the one-loop path gives for a page: (sections, spans), or None where it leaves the page to the tokenizer."""
    out = sections._Columns()
    found = sections._walk_plain(page, "T", sections._actions(frozenset(extra)), {}, out)
    assert found or out.size() == (0, 0)
    return (out.sections, out.spans) if found else None


def columns_of_walk(page, extra=()):
    out = sections._Columns()
    out.extend(run(page, wrap=False, extra_containers=extra))
    return out.sections, out.spans


def test_pages_of_plain_tags_need_no_tokenizer(spark, sf, monkeypatch):
    from articlelake.plans import corpus

    page = corpus.articles(spark, sf).orderBy("c").first().html.replace("\N{EN DASH}", "-")
    expected = columns_of_walk(page)
    monkeypatch.setattr(sections._Soup, "read", None)
    assert columns_of(page) == expected


@pytest.mark.parametrize(
    "body",
    [
        "<section><p>a</p><section><p>b<b>c</b></p><h2 id=\"References\">R</h2><p>d</p></section><p>e</p></section>",
        "<p>a<section>x<table><tr><td>b<i>c</i><p id=\"Citations\">d</p></td></tr></table></section>f<u>g</u></p>",
        "<table><tr><td rowspan=\"2\">a</td><section><td>b</td><h3 id=\"Citations\">c</h3></section><th>d</th></tr></table>",
        "<section><h2><section>a</section>b</h2><figure>c<p id=\"Bibliography\">d</p></figure></section><p>e</p>",
        "<ul><li>a<b>b<ul><li>c</b>d</li></ul></ul>e</p><p/><hr/>f",
        "<p>a<a href=\"./A\"></a><b> \n</b>x<span>\xa0y\x0b</span></p><caption>c<p>d</p></caption>",
    ],
)
def test_plain_pages_give_what_the_walk_gives(body):
    page = f"<html><head><title>T</title></head><body>{body}</body></html>\n"
    assert columns_of(page) == columns_of_walk(page)
    assert columns_of(page, ("figure",)) == columns_of_walk(page, ("figure",))


@pytest.mark.parametrize(
    "body",
    [
        "<p>a&amp;b</p>", "<p>a<!-- b --></p>", "<p>a > b</p>", "<p>a < b</p>", "<P>a</P>", "<p\0>a</p>", "<script>a</script>", "<pre> </pre>",
        "<title>a<b>b</b></title>", "<p a=b>c</p>", "<section><p id=\"Citations\">a</p></section><p id=\"Citations\">b</p>",
        "<h2>a<section><p id=\"Citations\">b</p></section></h2>", "<div>" * 300 + "</p>",
    ],
)
def test_other_pages_are_left_to_the_tokenizer(body):
    assert columns_of(f"<body>{body}</body>") is None
    assert columns_of(f"<section><body id=\"Citations\">{body}</body></section>") is None
    assert columns_of("<body><p>a") is None
    assert columns_of("a>p<b") is None


_PARTS = st.sampled_from(
    ["x", " ", " y\n", "<p>", "</p>", "<b>", "</b>", "<section>", "</section>", "<li>", "</li>", "<table>", "</table>", "<tr>", "</tr>",
     "<td>", "</td>", "<h2 id=\"References\">", "<h2>", "</h2>", "<nav>", "</nav>", "<a href=\"./A\">", "</a>", "<br>", "<p id=\"Citations\"/>", "<body>", "</body>"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(_PARTS, max_size=40))
def test_one_loop_equals_tokenizer_and_walk(parts):
    page = f"<html><body>{''.join(parts)}</body></html>"
    found = columns_of(page)
    assert found is None or found == columns_of_walk(page)

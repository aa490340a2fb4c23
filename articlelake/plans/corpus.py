"""Article dumps derived from the relational tables, for queries and tests.

One article per customer (and per 100,000 order keys, so no article grows without bound),
holding all its orders. The expected results of the section and date jobs follow from the
relations, so an oracle can compute them without parsing anything. See FIXTURES.md.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.archive import pack, write_files

AS_OF = datetime(2024, 1, 1)
ARTICLES_PER_FILE = 200
ORDERS_PER_PAGE = 100_000

# First words of titles in several scripts, and the search that each answers to.
SCRIPTS = {
    "Ørsted": "ors", "Łódź": "LODZ", "Ælfred": "Aelf", "STRAẞE": "strass", "Αθήνα": "ΑΘΗ", "Ёлка": "елк", "Đỗ": "Do", "Čačak": "čaca",
    "Йод": "йо", "Ναΐς": "ναισ", "œuvre": "OEU", "İzmir": "izm", "カナ": "かな", "ﬁnale": "fin", "שלום": "שלומ", "Ð": "d ",
}

_written: dict[tuple[str, str, bool, bool], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _date_text():
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    year = F.year(d)
    century = F.call_function("div", year - 1, F.lit(100)) + 1
    texts = [
        F.date_format(d, "d MMMM yyyy"),
        F.date_format(d, "MMMM yyyy"),
        F.date_format(d, "yyyy"),
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(d, "MMMM d, yyyy"),
        F.concat((year - year % 10).cast("string"), F.lit("s")),
        F.concat(century.cast("string"), F.when(century == 21, "st").otherwise("th"), F.lit(" century")),
        F.concat(year.cast("string"), F.lit(" BC")),
    ]
    chosen = texts[-1]
    for i in range(len(texts) - 2, -1, -1):
        chosen = F.when(key % 8 == i, texts[i]).otherwise(chosen)
    return chosen


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c, page, title, dump_file_id, file_name, dump_idx, orders, ...)``: what an article is made of, before any HTML."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    # The exchange a join by customer needs anyway, with a fixed partition count: the few bytes of a small test
    # table still give every core a share of the parsing. Orders are grouped where they meet their customer.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = (
        orders.select(
            F.col("o_custkey").alias("c"),
            F.call_function("div", F.col("o_orderkey"), F.lit(ORDERS_PER_PAGE)).alias("page"),
            F.struct(
                F.col("o_orderkey").alias("k"),
                F.concat(F.lit("K"), F.col("o_orderkey").cast("string")).alias("name"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_orderpriority").alias("priority"),
                _date_text().alias("date"),
            ).alias("o"),
        )
        .repartition(parts, "c")
        .groupBy("c", "page")
        .agg(F.sort_array(F.collect_list("o")).alias("orders"))
    )
    people = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("c"), "c_name", "c_mktsegment", "n_name"
    )
    people = people.repartition(parts, "c")
    empty = F.array().cast(pages.schema["orders"].dataType)
    joined = people.join(pages, "c", "left").select(
        "c", "c_name", "c_mktsegment", "n_name",
        F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("orders", empty).alias("orders"),
    )
    file_no = F.call_function("div", F.col("c"), F.lit(ARTICLES_PER_FILE))
    title = F.when(F.col("page") == 0, F.col("c_name")).otherwise(
        F.concat("c_name", F.lit(" page "), F.col("page").cast("string"))
    )
    return joined.select(
        "c", "page", "c_name", "c_mktsegment", "n_name", title.alias("title"),
        (file_no + 1).alias("dump_file_id"),
        F.concat(F.lit("dump_"), F.lpad((file_no + 1).cast("string"), 9, "0"), F.lit(".ndjson")).alias("file_name"),
        (F.col("c") % ARTICLES_PER_FILE + F.col("page") * ARTICLES_PER_FILE).alias("dump_idx"),
        "orders",
    )


def page_html():
    """HTML of a page, from the columns of :func:`pages`."""
    cells = F.transform("orders", lambda o: F.concat(
        F.lit("<tr><td>"), o["name"], F.lit("</td><td>"), o["status"], F.lit("</td><td>"), o["date"], F.lit("</td></tr>")
    ))
    items = F.transform("orders", lambda o: F.concat(
        F.lit("<li>Order "), o["name"], F.lit(" was placed on "), o["date"], F.lit(". It is "), o["priority"], F.lit(".</li>")
    ))
    return F.concat(
        F.lit("<html><head><title>"), F.col("c_name"), F.lit("</title></head><body><section><p>Customer <b>"),
        F.col("c_name"), F.lit('</b> lives in <a href="./'), F.col("n_name"), F.lit('">'), F.col("n_name"),
        F.lit('</a> – see <a href="./File:x.png">file</a> and <a href="./New?redlink=1">new</a></p></section>'),
        F.lit('<section><h2>Orders</h2><table><thead><tr><th colspan="2">Key</th><th>Date</th></tr></thead><tbody>'),
        F.array_join(cells, ""),
        F.lit("</tbody></table></section><section><h3>History</h3><ul>"),
        F.array_join(items, ""),
        F.lit('</ul></section><section><h2 id="References">References</h2><p>removed in 1999</p></section></body></html>'),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c, page, title, dump_file_id, file_name, dump_idx, html, ...)`` before JSON encoding."""
    return pages(spark, sf_dir).withColumn("html", page_html()).drop("n_name", "orders")


def wikitext():
    c = F.col("c")
    previous = F.concat(F.lit("Customer#"), F.lpad((c - 1).cast("string"), 9, "0"))
    return F.when(c % 11 != 0, F.when(c % 10 == 7, F.concat(F.lit("#REDIRECT[["), previous, F.lit("]]"))).otherwise("plain"))


def abstract():
    return F.when(
        F.col("c") % 13 != 0,
        F.repeat(F.concat(F.col("c_mktsegment"), F.lit(" account, ")), (F.col("c") % 90).cast("int")),
    )


def document():
    """The JSON document of a page, from the columns of :func:`pages`."""
    c = F.col("c")
    modified = F.date_format(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(c % 100000 as int))"),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    neighbour = F.concat(F.lit("Customer#"), F.lpad((c - 1).cast("string"), 9, "0"))
    follower = F.concat(F.lit("Customer#"), F.lpad((c + 1).cast("string"), 9, "0"))
    url = F.concat(F.lit("https://wiki.example.org/wiki/"), c.cast("string"))

    def redirect(name, link):
        return F.struct(name.cast("string").alias("name"), link.cast("string").alias("url"))

    alias = redirect(F.concat(F.lit("Alias "), F.col("title")), F.when(c % 3 != 0, F.concat(url, F.lit("/alias"))))
    nameless = redirect(F.lit(None), F.concat(url, F.lit("/nameless")))
    taken = F.when(c % 50 == 49, F.array(redirect(neighbour, url))).when(
        c % 50 == 24, F.array(redirect(follower, url))
    ).otherwise(F.array().cast("array<struct<name:string,url:string>>"))
    return F.to_json(
        F.struct(
            F.col("title").alias("name"),
            url.alias("url"),
            F.struct(page_html().alias("html"), wikitext().alias("wikitext")).alias("article_body"),
            F.when(c % 17 != 0, modified).alias("date_modified"),
            abstract().alias("abstract"),
            F.when(c % 5 != 0, F.concat(F.array(alias, nameless), taken)).alias("redirects"),
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dump_file_id, file_name, dump_idx, value)`` with one JSON document per row."""
    return pages(spark, sf_dir).select("dump_file_id", "file_name", "dump_idx", document().alias("value"))


def dump_folder(spark: SparkSession, sf_dir: str, compress: bool = False, ranged: bool = False) -> str:
    """The same lines as files, one folder per dump file; written once per session: plain, with gzip, or with gzip in
    members whose byte ranges can be read."""
    key = (spark.sparkContext.applicationId, sf_dir, compress, ranged)
    if key not in _written:
        path = scratch_path(spark, "dumps")
        if ranged:
            pack(pages(spark, sf_dir), path, document(), ranged=True)
        else:
            write_files(pages(spark, sf_dir), path, compress, value=document())
        _written[key] = path
    return _written[key]


def rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per supplier with the shapes that dump articles lack: nested lists and tables, definition and
    ordered lists, every heading and format, captions, row spans, loose text, dropped tags, a paragraph
    longer than one stored piece, and the three other boilerplate ids."""
    supplier = table(spark, sf_dir, "supplier")
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    pieces = [
        "<body>loose<section><h2>Head <i>of</i> ", key, "</h2><p>One <em>two</em> <strong>three</strong> ", name, "</p>",
        "<blockquote>said ", name, "</blockquote></section>",
        "<section><h3>Sub</h3><h4>Deep</h4><ol><li>lost<ul><li>in ", key, "</li></ul>after</li></ol>",
        "<dl><dt>term</dt><dd>about ", name, "</dd></dl></section>",
        "<section><table><caption>cap</caption><tr><th rowspan=\"2\">h</th><td colspan=\"3\">a<table><tr><td>in ", key,
        "</td></tr></table>b</td></tr><tr><td>c</td></tr></table></section>",
        "<section><p>&lt;span gone</p><p>kept<script>var x;</script><sup>9</sup><abbr>ab</abbr></p><p>", F.repeat(F.lit("long "), 3000), key, "</p></section>",
        "<section><h2 id=\"External_links\">E</h2><p>gone</p></section><section><div><h3 id=\"Bibliography\">B</h3></div><p>gone</p></section>",
        "<section><h2 id=\"Citations\">C</h2><p>gone</p></section><section><h2>Last</h2></section></body>",
    ]
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
    return supplier.select("s_suppkey", name.alias("title"), html.alias("html"))


def dated_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One section per order whose middle sentence holds a date in one of the rarer forms."""
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    year = F.year(d).cast("string")
    day = F.least(F.dayofmonth(d), F.lit(28)).cast("string")
    month, small = F.date_format(d, "MMMM"), (key % 900 + 1).cast("string")
    forms = [
        F.concat(day, F.lit(" "), month, F.lit(" "), year, F.lit(" BC")),
        F.concat(F.substring(month, 1, 3), F.lit(" "), day, F.lit(", "), year),
        F.concat(F.lit("AD "), small),
        F.concat(small, F.lit(" AD")),
        F.concat(year, F.lit("-"), (F.year(d) + 3).cast("string")),
        F.concat((key % 30 + 1).cast("string"), F.lit("th century BC")),
        F.concat(month, F.lit(" "), year, F.lit(" BC")),
        F.concat(year, F.lit("000 BC")),
    ]
    chosen = forms[-1]
    for i in range(len(forms) - 2, -1, -1):
        chosen = F.when(key % 8 == i, forms[i]).otherwise(chosen)
    text = F.concat(F.lit("A first sentence. Order K"), key.cast("string"), F.lit(" is of "), chosen, F.lit(", it says! And an end."))
    return table(spark, sf_dir, "orders").select(key.alias("article_id"), F.lit(0).alias("section_id"), text.alias("text"))


def composed_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One section per order whose sentence holds a date made of two, or of a date and a word."""
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    year, day = F.year(d), F.least(F.dayofmonth(d), F.lit(25))
    month = F.date_format(d, "MMMM")
    # From the first day on, as December has no month after it.
    next_month = F.date_format(F.add_months(F.trunc(d, "year"), F.least(F.month(d), F.lit(11))), "MMMM")
    first_month = F.date_format(F.add_months(F.trunc(d, "year"), F.least(F.month(d), F.lit(11)) - 1), "MMMM")
    ordinal = F.when(day.isin(1, 21), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")
    decade = (year - year % 10).cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    forms = [
        text(day, "-", day + key % 3 + 1, " ", month, " ", year),
        text(first_month, " to ", next_month, " ", year),
        text(year, "/", F.lpad(((year + 1) % 100).cast("string"), 2, "0")),
        text(day, ordinal, " of ", month, " ", year),
        text(month, " ", day, ordinal, ", ", year),
        text("early ", decade, "s"),
        text("mid-", decade, "s"),
        text("late ", decade, "s"),
    ]
    chosen = forms[-1]
    for i in range(len(forms) - 2, -1, -1):
        chosen = F.when(key % 8 == i, forms[i]).otherwise(chosen)
    return table(spark, sf_dir, "orders").select(
        key.alias("article_id"), F.lit(0).alias("section_id"), text("Order K", key, " is of ", chosen, ", it says.").alias("text")
    )


def chained_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions that lean on each other: one per order, three sections per customer."""
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = (
        F.when(key % 7 <= 1, F.date_format(d, "d MMMM yyyy"))
        .when(key % 7 == 2, "2 years later")
        .when(key % 7 == 3, "3 days earlier")
        .when(key % 7 == 4, "bad date")
        .when(key % 7 == 5, "the following month")
        .otherwise(F.date_format(d, "d MMMM"))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("article_id"),
        (key % 3).cast("int").alias("section_id"),
        F.lit(None).cast("bigint").alias("start_date"),
        F.lit(None).cast("bigint").alias("end_date"),
        F.lit(None).cast("int").alias("parse_status"),
        text.alias("date_text"),
        key.cast("int").alias("start_pos"),
        (key + F.length(text)).cast("int").alias("end_pos"),
        F.lit(None).cast("string").alias("display_text"),
    )


def chained_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those mentions as sections: a sentence for each order, an article for each customer and 100,000 order
    keys, so that none grows without bound."""
    key = F.col("start_pos")
    page = F.call_function("div", key, F.lit(ORDERS_PER_PAGE))
    article = F.shiftleft(F.col("article_id").cast("bigint"), 20) + page
    sentence = F.concat(F.lit("Order K"), key.cast("string"), F.lit(" came on "), F.col("date_text"), F.lit("."))
    said = F.transform(F.sort_array(F.collect_list(F.struct(key, sentence.alias("sentence")))), lambda s: s["sentence"])
    texts = chained_mentions(spark, sf_dir).groupBy(article.alias("article_id"), "section_id").agg(F.array_join(said, " ").alias("text"))
    none = [F.lit(None).cast("int").alias(c) for c in ("parent_section_id", "row_idx", "column_idx", "row_span", "column_span")]
    return texts.select(
        "article_id", "section_id", F.lit(0).alias("ext_text_count"), *none, F.lit("PARAGRAPH").alias("tag"),
        F.lit(None).cast("string").alias("format"), "text", F.lit(None).cast("string").alias("is_parsed"),
    )

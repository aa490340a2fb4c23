import gzip
import io
import json
import os
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from articlelake.operators import detail, events, ingest, sections
from articlelake.plans import corpus
from articlelake.schemas import TABLES
from articlelake.session import stage
from articlelake.sources import archive
from articlelake.sources import lines as src
from articlelake.sources import offsets
from articlelake.sources.store import Store
from articlelake.streaming.ingest import ingest_stream

NOW = datetime(2024, 1, 1)


def document(name, **more):
    return json.dumps({"name": name, "url": f"u/{name}", "article_body": {"html": f"<body><p>{name} in 1999</p></body>"}, **more})


def lines_of(spark, *documents):
    rows = [(1, "f", i, d) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "dump_file_id bigint, file_name string, dump_idx bigint, value string")


@pytest.fixture
def dumps(tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    for f in range(3):
        with open(folder / f"d{f}.ndjson", "w") as out:
            for i in range(200 * (1 + 5 * (f == 1))):
                out.write("\n" if i == 7 else document(f"{f}/{i}", pad="x" * (i % 50)) + "\n")
    return str(folder)


def numbered(spark, folder):
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, folder))
    return src.read_lines(spark, folder, catalog)


def test_line_numbers_across_many_splits(spark, dumps):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = numbered(spark, dumps)
        assert lines.rdd.getNumPartitions() > 20
        rows = lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 200 + 1200 + 200
    for r in rows:
        assert r.dump_file_id == int(r.file_name[1]) + 1
        if r.dump_idx == 7:
            assert r.value == ""
        else:
            assert json.loads(r.value)["name"] == f"{r.file_name[1]}/{r.dump_idx}"


def test_a_changed_split_layout_fails_loudly(spark, dumps):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, dumps))
        lines = src.read_lines(spark, dumps, catalog)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # Planned only now, with other splits than the counting pass had.
    with pytest.raises(Exception, match="scan splits changed"):
        lines.collect()


def test_shares_of_files_and_unknown_files(spark, dumps, monkeypatch):
    want = sorted(map(tuple, numbered(spark, dumps).collect()))
    monkeypatch.setattr(src, "SPLITS_A_SHARE", 1)
    assert sorted(map(tuple, numbered(spark, dumps).collect())) == want
    listed = src.list_files(spark, dumps)
    catalog = src.upsert_catalog(src.empty_catalog(spark), listed.where("file_name <> 'd1.ndjson'"))
    assert {r.file_name for r in src.read_lines(spark, dumps, catalog).collect()} == {"d0.ndjson", "d2.ndjson"}
    assert [r.file_name for r in src.uncatalogued(listed, catalog).collect()] == ["d1.ndjson"]


def test_parts_appended_later_keep_earlier_positions(spark, tmp_path):
    target = str(tmp_path / "parts")
    rows = spark.range(60).selectExpr("'f' as file_name", "id as dump_idx", "cast(id as string) as value")
    for low, high in ((0, 25), (25, 60)):
        archive.write_files(rows.where(f"dump_idx >= {low} and dump_idx < {high}"), target)
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, target, packed=True))
    lines = src.read_lines(spark, target, catalog, packed=True)
    assert lines.count() == 60 and lines.where("cast(dump_idx as string) <> value").count() == 0


def test_stream_numbers_parts_that_arrive_later(spark, tmp_path):
    arriving = str(tmp_path / "arriving")
    store = Store(spark, str(tmp_path / "store"))
    documents = [document(f"t{i}") for i in range(40)]
    rows = spark.createDataFrame([("f", i, d) for i, d in enumerate(documents)], "file_name string, dump_idx long, value string")
    for low, high in ((0, 15), (15, 40)):
        archive.write_files(rows.where(f"dump_idx >= {low} and dump_idx < {high}"), arriving)
        for _ in range(2):  # the second start finds nothing new
            ingest_stream(spark, arriving, store, str(tmp_path / "chk"), NOW, packed=True).awaitTermination()
    got = {r.title: r.id for r in store.read("article").collect()}
    assert got == {f"t{i}": (1 << 32) + i for i in range(40)}
    assert store.read("dump_part").agg(F.sum("lines")).first()[0] == 40


def test_wanted_lines(spark):
    lines = spark.range(200_000).selectExpr("id % 2 + 1 as dump_file_id", "'f' as file_name", "id div 2 as dump_idx", "'x' as value")
    for wanted in ("true", "false", "dump_file_id = 1 and dump_idx % 3 = 0", "dump_idx between 30000 and 70000 or dump_idx = 99999"):
        keys = lines.where(wanted).select("dump_file_id", "dump_idx")
        got = src.wanted_lines(lines, keys.unionAll(keys.limit(5)))
        assert got.columns == lines.columns and got.count() == keys.count()
        assert got.select("dump_file_id", "dump_idx").exceptAll(keys).count() == 0


def test_wanted_lines_test_one_mask(spark, monkeypatch):
    """What a line is compared with does not grow with the wanted lines of its file; positions may be negative or NULL."""
    staged = []
    monkeypatch.setattr(src, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    lines = spark.range(-200, 20_000).selectExpr("1L as dump_file_id", "'f' as file_name", "nullif(id, 7) as dump_idx", "'x' as value")
    keys = lines.where("dump_idx % 3 = 0 or dump_idx is null").select("dump_file_id", "dump_idx")
    got = src.wanted_lines(lines, keys)
    assert {t for _, t in staged[0].dtypes} == {"bigint"} and staged[0].count() < 330
    assert got.select("dump_idx").exceptAll(keys.where("dump_idx is not null").select("dump_idx")).count() == 0
    assert got.count() == keys.where("dump_idx is not null").count()


def test_lines_are_made_where_they_are_written(spark, tmp_path):
    """Only what a line is made of is shuffled; plain and packed files hold the same lines in the same order."""
    rows = spark.range(900).selectExpr("1L as dump_file_id", "concat('f', id % 3) as file_name", "899 - id as dump_idx", "id as n")
    text = F.concat(F.lit("line "), F.col("n").cast("string"))
    archive.write_files(rows, str(tmp_path / "plain"), value=text)
    archive.pack(rows, str(tmp_path / "packed"), text)
    expected = sorted((f"f{i % 3}", 899 - i, f"line {i}") for i in range(900))
    for folder in ("plain", "packed"):
        listed = src.list_files(spark, str(tmp_path / folder), packed=True)
        catalog = src.upsert_catalog(src.empty_catalog(spark), listed)
        got = src.read_lines(spark, str(tmp_path / folder), catalog, packed=True).select("file_name", "dump_idx", "value").collect()
        by_file = {f: [t for n, _, t in expected if n == f] for f in ("f0", "f1", "f2")}
        assert sorted((r.file_name, r.dump_idx, r.value) for r in got) == sorted((f, i, t) for f, ts in by_file.items() for i, t in enumerate(ts))


def test_packed_dumps_hold_the_same_lines(spark, sf):
    plain, packed = (spark.read.schema("value string, file_name string").text(corpus.dump_folder(spark, sf, compress=c)) for c in (False, True))
    assert packed.count() == corpus.lines(spark, sf).count() and all(f.endswith(".gz") for f in packed.inputFiles())
    assert packed.exceptAll(plain).count() == 0


def test_catalog_upsert_keeps_ids(spark, dumps):
    listed = src.list_files(spark, dumps)
    known = spark.createDataFrame([(7, "d1.ndjson", 1, NOW)], TABLES["dump_file"] if "dump_file" in TABLES else "")
    got = {r.file_name: (r.id, r["size"]) for r in src.upsert_catalog(known, listed).collect()}
    assert {k: v[0] for k, v in got.items()} == {"d0.ndjson": 8, "d1.ndjson": 7, "d2.ndjson": 9}
    assert got["d1.ndjson"][1] > 1


def test_high_water_of_an_empty_table(spark):
    empty = spark.createDataFrame([], TABLES["article"])
    assert tuple(src.high_water(empty).first()) == (1, -1)


def test_resume_equals_one_run(spark, dumps):
    lines = numbered(spark, dumps).where("value <> ''")
    empty = spark.createDataFrame([], TABLES["article"])
    whole = ingest.ingest(src.resume_lines(lines, empty), empty, NOW)
    first = ingest.ingest(lines.where("dump_file_id = 1 or (dump_file_id = 2 and dump_idx <= 300)"), empty, NOW)
    second = ingest.ingest(src.resume_lines(lines, first), first, NOW)
    assert second.count() == whole.count() - first.count()
    assert first.unionByName(second).exceptAll(whole).count() == 0


@pytest.mark.parametrize("packed", [False, True])
def test_pending_lines_open_pending_files_only(spark, tmp_path, packed):
    folder = tmp_path / "d"
    for f in range(3):
        target = folder / f"file_name=d{f}" if packed else folder
        target.mkdir(parents=True, exist_ok=True)
        (target / ("part-00000.txt" if packed else f"d{f}")).write_text("".join(document(f"{f}/{i}") + "\n" for i in range(9)))
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, str(folder), packed))
    stored = ingest.ingest(src.read_lines(spark, str(folder), catalog, packed), None, NOW)
    stored = spark.createDataFrame(stored.where("dump_file_id < 2 or (dump_file_id = 2 and dump_idx <= 4)").collect(), TABLES["article"])
    # The finished file is unreadable now; it must not matter.
    done = folder / "file_name=d0" / "part-00000.txt" if packed else folder / "d0"
    done.write_bytes(b"\n" * 5)
    got = src.read_pending_lines(spark, str(folder), catalog, stored, packed)
    assert sorted((r.dump_file_id, r.dump_idx) for r in got.collect()) == [(2, i) for i in range(5, 9)] + [(3, i) for i in range(9)]
    marked = src.scan_lines(spark, str(folder), packed, only=["d1", "d2"])
    assert marked.select("file_path").distinct().count() == 2
    assert ingest.ingest_dumps(spark, str(folder), catalog, stored, NOW, packed).count() == 13


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "tars"
    folder.mkdir()
    for a in range(2):
        with tarfile.open(folder / f"a{a}.tar.gz", "w:gz") as tar:
            directory = tarfile.TarInfo(f"sub{a}")
            directory.type = tarfile.DIRTYPE
            tar.addfile(directory)
            for m in range(2):
                data = "".join(document(f"{a}{m}/{i}") + "\n" for i in range(30)).encode()
                info = tarfile.TarInfo(f"m{a}{m}.ndjson")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    return str(folder)


def test_read_archives(spark, archives, monkeypatch):
    rows = archive.read_archives(spark, archives).collect()
    assert len(rows) == 120
    assert all(json.loads(r.value)["name"] == f"{r.file_name[1:3]}/{r.dump_idx}" for r in rows)


def test_every_layout_gives_the_same_lines(spark, archives, tmp_path):
    """Archives, the packed folders they unpack to, and plain files."""
    packed, plain = str(tmp_path / "packed"), tmp_path / "plain"
    archive.unpack(spark, archives, packed)
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, packed, packed=True))
    from_archives = archive.read_dump(spark, archives, catalog, "archives")
    plain.mkdir()
    for row in from_archives.groupBy("file_name").agg(F.sort_array(F.collect_list(F.struct("dump_idx", "value"))).alias("v")).collect():
        (plain / row.file_name).write_text("".join(x.value + "\n" for x in row.v))
    want = sorted(map(tuple, from_archives.collect()))
    assert len(want) == 120
    assert sorted(map(tuple, archive.read_dump(spark, packed, catalog, "packed").collect())) == want
    assert sorted(map(tuple, archive.read_dump(spark, str(plain), catalog).collect())) == want
    with pytest.raises(ValueError):
        archive.read_dump(spark, packed, catalog, "zip")


def test_unpack_skips_present_members_then_pack(spark, archives, tmp_path):
    target = str(tmp_path / "unpacked")
    known = spark.createDataFrame([("m00.ndjson",)], "file_name string")
    archive.unpack(spark, archives, target, known)
    listed = src.list_files(spark, target, packed=True)
    assert sorted(r.file_name for r in listed.collect()) == ["m01.ndjson", "m10.ndjson", "m11.ndjson"]
    catalog = src.upsert_catalog(src.empty_catalog(spark), listed)
    lines = src.read_lines(spark, target, catalog, packed=True)
    archive.unpack(spark, archives, target, listed.select("file_name"))
    assert {r.file_name for r in src.list_files(spark, target, packed=True).collect()} == {
        "m00.ndjson", "m01.ndjson", "m10.ndjson", "m11.ndjson",
    }
    packed = str(tmp_path / "packed")
    archive.pack(lines, packed)
    again = src.read_lines(spark, packed, catalog, packed=True)
    assert again.exceptAll(lines).count() == 0 and lines.exceptAll(again).count() == 0
    assert all(p.endswith(".txt.gz") for p in src.scan_lines(spark, packed, packed=True).inputFiles())
    assert again.count() == 90


def test_one_large_file_is_written_by_several_tasks(spark, tmp_path):
    lines = spark.range(1000).selectExpr("1L as dump_file_id", "'big' as file_name", "id as dump_idx", "cast(id as string) as value")
    target = str(tmp_path / "big")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive.write_files(lines, target)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    scan = src.scan_lines(spark, target, packed=True)
    assert scan.select("file_path").distinct().count() > 1
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, target, packed=True))
    assert src.number_lines(scan, catalog).where("cast(dump_idx as string) <> value").count() == 0


def test_rejected_lines_and_optional_fields(spark):
    lines = lines_of(
        spark,
        document("ok", date_modified="2024-1-2T03:04:05Z", abstract="x" * 1001, redirects=[{"name": "r"}, {"url": "u"}]),
        "{broken",
        json.dumps({"url": "u", "article_body": {}}),
        json.dumps({"name": "n", "article_body": {}}),
        json.dumps({"name": "n", "url": "u"}),
        document("d", date_modified="yesterday"),
        document("e", date_modified="2024-01-02T03:04:05+02:00"),
    )
    reasons = {r.dump_idx: r.reason for r in ingest.rejected_lines(lines).collect()}
    assert reasons == {1: "malformed", 2: "no name", 3: "no url", 4: "no body", 5: "bad date_modified", 6: "bad date_modified"}
    rows = ingest.article_rows(lines, NOW).orderBy("alias_ord").collect()
    assert [(r.title, r.redirect, r.url) for r in rows] == [("ok", None, "u/ok"), ("r", "ok", None)]
    assert len(rows[0].description) == 1000 and rows[0].description.endswith("...")
    assert rows[0].wiki_update_ts == datetime(2024, 1, 2, 3, 4, 5)
    assert rows[0].id == (1 << 32) and rows[1].id < 0


@pytest.mark.parametrize(
    "wikitext,target",
    [("#REDIRECT[[A]] [[B]]", "A]] [[B"), ("#REDIRECT [[A]]", None), ("x\n#REDIRECT[[A\nB]]", None), ("#redirect[[A]]", None),
     ("a #REDIRECT[[A]]\n#REDIRECT[[B]]", "A"), ("#REDIRECT[[A\rB\x85C\u2028D]]", "A\rB\x85C\u2028D"), (None, None)],
)
def test_redirect_target(spark, wikitext, target):
    from articlelake.functions.article import redirect_target

    df = spark.createDataFrame([(wikitext,)], "w string")
    assert df.select(redirect_target(F.col("w"))).first()[0] == target


def test_first_title_wins(spark):
    lines = lines_of(
        spark,
        document("A", redirects=[{"name": "B"}, {"name": "C"}]),
        document("B"),
        document("D", redirects=[{"name": "C"}]),
    )
    rows = {r.title: r.redirect for r in ingest.ingest(lines, None, NOW).collect()}
    assert rows == {"A": None, "B": "A", "C": "A", "D": None}


def test_metrics(spark):
    observed, seen = ingest.with_metrics(lines_of(spark, "ab", "abcd"))
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"articles": 2, "chars": 6, "chars_per_article": 3.0}


def test_stream_equals_batch_and_reads_each_file_once(spark, dumps, tmp_path):
    import os
    import shutil

    arriving = tmp_path / "arriving"
    arriving.mkdir()
    store = Store(spark, str(tmp_path / "store"))
    batch = ingest.ingest(numbered(spark, dumps), None, NOW)
    for name in sorted(os.listdir(dumps)):
        if name.endswith(".ndjson"):
            shutil.copy(f"{dumps}/{name}", arriving / name)
            ingest_stream(spark, str(arriving), store, str(tmp_path / "chk"), NOW).awaitTermination()
    got = store.read("article")
    assert got.count() == batch.count()
    assert got.select("id", "title").exceptAll(batch.select("id", "title")).count() == 0
    assert [r.id for r in store.read("dump_file").orderBy("file_name").collect()] == [1, 2, 3]


def test_store_replaces_the_table_it_reads(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.read("dump_file").count() == 0
    rows = spark.createDataFrame([(1, "a", 1, NOW), (2, "b", 1, NOW)], TABLES["dump_file"])
    store.append("dump_file", rows)
    store.append("dump_file", rows.selectExpr("id + 2 as id", "file_name", "size", "modified"))
    assert store.read("dump_file").count() == 4
    store.replace("dump_file", store.read("dump_file").where("id > 1"))
    assert sorted(r.id for r in store.read("dump_file").collect()) == [2, 3, 4]


def test_life_of_an_article(spark, tmp_path):
    """Ingest, refresh, scan, resolve, detail, refresh again: through stored tables."""
    lines = lines_of(spark, document("A", redirects=[{"name": "a"}]), document("B"), document("Empty").replace("1999", "none"))
    store = Store(spark, str(tmp_path / "lake"))
    store.append("article", ingest.ingest(lines, store.read("article"), NOW))
    for name, df in detail.refresh_articles(store.read_all(), lines, NOW).items():
        store.replace(name, df)
    tables = store.read_all()
    assert {r.title: r.err for r in tables["article"].collect()} == {"A": "UP_TO_DATE", "B": "UP_TO_DATE", "Empty": "UP_TO_DATE", "a": None}
    assert detail.needs_parse(tables["article"]).count() == 0
    assert detail.needs_parse(tables["article"], algorithm_date=detail.ALGORITHM_DATE).count() == 3

    todo = events.unparsed_sections(tables["article_section"], tables["article_section_ext_text"])
    store.append("parsed_event", events.parsed_events(events.scan_mentions(todo)))
    store.replace("article_section", events.mark_parsed(tables["article_section"], todo))
    tables = store.read_all()
    assert events.unparsed_sections(tables["article_section"], tables["article_section_ext_text"]).count() == 0
    assert events.unresolved_events(tables["parsed_event"]).count() == 2
    assert events.unresolved_events(tables["parsed_event"], limit=1).count() == 1
    store.replace("parsed_event", events.resolve_events(tables["parsed_event"], NOW))
    store.replace("article", events.articles_without_dates(tables["article"], store.read("parsed_event")))
    tables = store.read_all()
    assert events.unresolved_events(tables["parsed_event"]).count() == 0
    assert {r.title: r.no_dates for r in tables["article"].collect()} == {"A": False, "B": False, "Empty": True, "a": None}

    (bundle,) = detail.article_detail(tables, [1 << 32]).collect()
    assert [(s.section_id, s.tag, s.text) for s in bundle.article_section] == [(0, "HEADING", "A"), (1, "PARAGRAPH", "A in 1999")]
    assert bundle.parsed_event[0].date_text == "1999" and bundle.parsed_event[0].start_date == 915148800
    assert detail.article_detail(tables, [42]).count() == 0

    wanted = tables["article"].where("title = 'B'")
    again = detail.refresh_articles(tables, lines, NOW, wanted=wanted, force=True)
    assert {r.article_id for r in again["parsed_event"].collect()} == {1 << 32}
    assert again["article_section"].count() == 6
    assert again["article_section"].where("is_parsed is null").count() == 2


def test_refresh_keeps_what_it_cannot_replace(spark):
    """No HTML, no line: old rows stay and the article gets a state."""
    lines = lines_of(spark, document("A"), json.dumps({"name": "B", "url": "u", "article_body": {"wikitext": "x"}}), document("C"))
    tables = {name: spark.createDataFrame([], TABLES[name]) for name in TABLES}
    tables["article"] = ingest.ingest(lines, None, NOW).withColumn("err", F.lit("NEW_DUMP"))
    ids = [(1 << 32) + i for i in range(3)]
    old = [(i, 0, 0, None, None, None, None, None, "HEADING", None, "old", "Y") for i in ids]
    tables["article_section"] = spark.createDataFrame(old, TABLES["article_section"])
    got = detail.refresh_articles(tables, lines.where("dump_idx < 2"), NOW)
    assert {r.title: r.err for r in got["article"].collect()} == {"A": "UP_TO_DATE", "B": "PARSE_ERROR", "C": "PARSE_ERROR"}
    assert {r.article_id for r in got["article_section"].where("text = 'old'").collect()} == set(ids[1:])


def test_refresh_of_a_few_opens_their_files_only(spark, dumps):
    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, dumps))
    tables = {name: spark.createDataFrame([], TABLES[name]) for name in TABLES}
    stored = ingest.ingest(src.read_lines(spark, dumps, catalog), None, NOW)
    tables["article"] = spark.createDataFrame(stored.collect(), TABLES["article"])
    for name in ("d0.ndjson", "d2.ndjson"):  # unreadable now; it must not matter
        with open(f"{dumps}/{name}", "wb") as file:
            file.write(b"\xff" * 10)
    wanted = spark.createDataFrame([((2 << 32) + 5,), ((2 << 32) + 900,)], "id long")
    bundles, fresh = detail.detail_on_demand(spark, dumps, catalog, tables, NOW, wanted)
    assert {b.title: [s.text for s in b.article_section] for b in bundles.collect()} == {"1/5": ["1/5", "1/5 in 1999"], "1/900": ["1/900", "1/900 in 1999"]}
    tables.update(fresh)
    assert tables["article"].where("err = 'UP_TO_DATE'").count() == 2
    again, _ = detail.detail_on_demand(spark, dumps, catalog, tables, NOW, wanted)
    assert again.count() == 2
    changed, _ = detail.detail_on_demand(spark, dumps, catalog, tables, NOW, wanted, algorithm_date=detail.ALGORITHM_DATE)
    assert changed.count() == 2


def test_refresh_in_place_touches_its_files_only(spark, dumps, tmp_path):
    import os

    catalog = src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, dumps))
    store = Store(spark, str(tmp_path / "lake"))
    store.append("article", ingest.ingest(src.read_lines(spark, dumps, catalog), None, NOW))
    detail.refresh_store(store, dumps, catalog, NOW)
    assert store.read("article").where("err = 'UP_TO_DATE'").count() == 1597
    assert store.read("article_section").count() == 2 * 1597

    def files():
        top = f"{tmp_path}/lake/article_section/v1"
        return {b: sorted(os.listdir(f"{top}/{b}")) for b in os.listdir(top) if b.startswith("bucket=")}

    before = files()
    assert set(before) == {"bucket=1", "bucket=2", "bucket=3"}
    wanted = spark.createDataFrame([((2 << 32) + 5,)], "id long")
    detail.refresh_store(store, dumps, catalog, NOW, wanted, force=True)
    after = files()
    assert after["bucket=1"] == before["bucket=1"] and after["bucket=3"] == before["bucket=3"] and after["bucket=2"] != before["bucket=2"]
    assert store.read("article_section").count() == 2 * 1597 and store.read("article").count() == 1597
    tables = store.read_articles([(2 << 32) + 5])
    assert tables["article_section"].count() == 2 * 1199
    plan = tables["article_section"]._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert detail.article_detail(tables, [(2 << 32) + 5]).count() == 1
    # Bundles of stored articles: from their folders; stale ones are refreshed in place first.
    (bundle,) = detail.stored_detail(store, dumps, catalog, NOW, [(2 << 32) + 5]).collect()
    assert bundle.title == "1/5" and [s.text for s in bundle.article_section] == ["1/5", "1/5 in 1999"] and files() == after
    plan = detail.stored_detail(store, dumps, catalog, NOW, [(2 << 32) + 5])._jdf.queryExecution().toString()
    assert plan.count("bucket#") > 0 and "PushedFilters: [IsNotNull(article_id), EqualTo(article_id,8589934597)]" in plan
    (bundle,) = detail.stored_detail(store, dumps, catalog, NOW, [(2 << 32) + 6], force=True).collect()
    assert bundle.title == "1/6" and files()["bucket=1"] == before["bucket=1"] and files()["bucket=2"] != after["bucket=2"]
    # Events of refreshed articles go, even if a folder has no others.
    events.event_flow(store, NOW)
    assert store.read("parsed_event").where("article_id >> 32 = 1").count() > 0
    whole_file = store.read("article").where("dump_file_id = 1").select("id")
    others = store.read("parsed_event").where("article_id >> 32 > 1").count()
    detail.refresh_store(store, dumps, catalog, NOW, whole_file, force=True)
    assert store.read("parsed_event").where("article_id >> 32 = 1").count() == 0
    assert store.read("parsed_event").count() == others


def flow_store(spark, tmp_path, *titles):
    lines = lines_of(spark, *[document(t) for t in titles])
    store = Store(spark, str(tmp_path / "lake"))
    store.append("article", ingest.ingest(lines, None, NOW))
    for name, df in detail.refresh_articles(store.read_all(), lines, NOW).items():
        store.replace(name, df)
    return store, lines


def unscanned(store):
    return events.with_scans(store.read("article_section"), store.read("section_scan")).where("is_parsed is null").count()


def test_event_flow_can_break_off_anywhere(spark, tmp_path):
    store, _ = flow_store(spark, tmp_path, "A", "B")
    events.event_flow(store, NOW)
    want = sorted(map(tuple, store.read("parsed_event").collect()))
    assert len(want) == 2 and all(r[2] is not None for r in want) and unscanned(store) == 0
    # Events were stored, the log was not: the next run must not store them twice.
    store.replace("section_scan", store.read("section_scan").limit(0))
    assert unscanned(store) == 4
    for _ in range(2):
        events.event_flow(store, NOW)
        assert sorted(map(tuple, store.read("parsed_event").collect())) == want and unscanned(store) == 0


def files_of(path):
    import os

    return {(top, f): os.stat(f"{top}/{f}").st_mtime_ns for top, _, names in os.walk(path) for f in names}


def test_event_flow_writes_no_text(spark, tmp_path):
    """Files of sections stay as they are; the log grows by keys; a run with nothing to do writes nothing."""
    store, lines = flow_store(spark, tmp_path, "A", "B")
    before = files_of(tmp_path / "lake/article_section")
    events.event_flow(store, NOW)
    assert files_of(tmp_path / "lake/article_section") == before
    everything = files_of(tmp_path / "lake")
    events.event_flow(store, NOW)
    assert files_of(tmp_path / "lake") == everything
    # A refreshed article is scanned again, and only it.
    wanted = store.read("article").where("title = 'B'")
    for name, df in detail.refresh_articles(store.read_all(), lines, NOW, wanted=wanted, force=True).items():
        store.replace(name, df)
    assert {r.article_id for r in events.pending_sections(store).collect()} == {(1 << 32) + 1}
    events.event_flow(store, NOW)
    assert unscanned(store) == 0 and store.read("parsed_event").count() == 2
    # Compaction moves the log into the sections and empties it.
    events.compact_scans(store, [1])
    assert store.read("section_scan").count() == 0 and store.read("article_section").where("is_parsed = 'Y'").count() == 4
    assert unscanned(store) == 0 and events.pending_sections(store).count() == 0


def test_store_keeps_its_newest_versions(spark, tmp_path):
    import os

    store = Store(spark, str(tmp_path / "s"), kept=3)
    for k in range(6):
        rows = spark.createDataFrame([(k, "a", 1, NOW)], TABLES["dump_file"])
        store.replace("dump_file", store.read("dump_file").unionByName(rows))
    assert sorted(os.listdir(tmp_path / "s/dump_file")) == ["v4", "v5", "v6"] and store.read("dump_file").count() == 6
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path / "s"), kept=1)


def test_parse_error_is_recorded(spark):
    lines = lines_of(spark, json.dumps({"name": "A", "url": "u", "article_body": {"html": "<body><![x["}}))
    tables = {name: spark.createDataFrame([], TABLES[name]) for name in TABLES}
    tables["article"] = ingest.ingest(lines, None, NOW)
    assert detail.refresh_articles(tables, lines, NOW)["article"].first().err == "PARSE_ERROR"


def test_corpus_files_hold_the_corpus(spark, sf):
    folder = corpus.dump_folder(spark, sf)
    assert src.scan_lines(spark, folder, packed=True).count() == corpus.lines(spark, sf).count()
    assert sections.article_pages(corpus.lines(spark, sf)).count() == corpus.lines(spark, sf).count()


def keyed(rows):
    return sorted((r.dump_file_id, r.file_name, r.dump_idx, r.value) for r in rows.collect())


def catalog_of(spark, folder):
    return stage(src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, folder)), "catalog")


def indexed(spark, folder, catalog):
    return stage(offsets.line_offsets(spark, folder, catalog), "offsets")


@pytest.fixture
def odd_dumps(dumps):
    """Beside the three dumps: no last line end, carriage returns and wide letters, a mark of byte order, a compressed file, nothing."""
    with open(f"{dumps}/e0.ndjson", "w", newline="") as out:
        out.write("\n".join(f"Zürich {i} \U0001f600\r" for i in range(130)) + "\n\nlast")
    with open(f"{dumps}/e1.ndjson", "wb") as out:
        out.write(b"\xef\xbb\xbf" + b"marked\n" * 70)
    with gzip.open(f"{dumps}/e2.ndjson.gz", "wt") as out:
        out.write("".join(f"packed {i}\n" for i in range(100)))
    with open(f"{dumps}/a name+with %20 signs.ndjson", "w") as out:
        out.write("one\ntwo\n")
    open(f"{dumps}/e3.ndjson", "w").close()
    return dumps


def test_lines_by_offset_equal_the_scan(spark, odd_dumps):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        catalog = catalog_of(spark, odd_dumps)
        index = indexed(spark, odd_dumps, catalog)
        every = stage(src.read_lines(spark, odd_dumps, catalog), "every")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    names = {r.file_name.split(".")[0] for r in index.select("file_name").distinct().collect()}
    assert {"d0", "d1", "d2", "e0"} <= names and not names & {"e1", "e2", "e3"}
    got = offsets.read_lines_by_offset(spark, odd_dumps, catalog, index, every)
    assert keyed(got) == keyed(every)
    wanted = every.where("dump_idx % 61 = 0").unionByName(every.where("dump_idx % 61 = 0"))
    assert keyed(offsets.read_lines_by_offset(spark, odd_dumps, catalog, index, wanted)) == keyed(every.where("dump_idx % 61 = 0"))


def test_one_line_reads_one_stretch_of_one_file(spark, dumps, tmp_path):
    catalog = catalog_of(spark, dumps)
    index = indexed(spark, dumps, catalog)
    kept = index.where("stretch = 3 and file_name = 'd1.ndjson'")
    bounds = kept.first()
    file = f"{dumps}/d1.ndjson"
    before, info = open(file, "rb").read(), os.stat(file)
    # Every byte outside the stretch is spoilt: nothing may depend on it.
    spoilt = b"?" * bounds.start + before[bounds.start : bounds.stop] + b"?" * (len(before) - bounds.stop)
    open(file, "wb").write(spoilt)
    os.utime(file, ns=(info.st_atime_ns, info.st_mtime_ns))
    wanted = spark.createDataFrame([(2, 200), (2, None), (None, 3), (2, 10**9)], "dump_file_id bigint, dump_idx bigint")
    rows = offsets.read_lines_by_offset(spark, dumps, catalog, index, wanted.where("dump_idx = 200 or dump_idx is null")).collect()
    assert [(r.article_id, r.dump_idx, json.loads(r.value)["name"]) for r in rows] == [((2 << 32) + 200, 200, "1/200")]
    assert offsets.read_lines_by_offset(spark, dumps, catalog, index, wanted.where("dump_idx > 1000")).count() == 0


def test_changed_files_are_scanned(spark, dumps):
    catalog = catalog_of(spark, dumps)
    index = indexed(spark, dumps, catalog)
    with open(f"{dumps}/d0.ndjson", "w") as out:
        out.write("".join(f"new {i}\n" for i in range(20)))
    every = src.read_lines(spark, dumps, catalog)
    wanted = every.select("dump_file_id", "dump_idx", F.lit("x").alias("stretch"), F.lit(1).alias("lines"))
    assert keyed(offsets.read_lines_by_offset(spark, dumps, catalog, index, wanted)) == keyed(every)


def test_offsets_of_nothing(spark, dumps):
    none = src.empty_catalog(spark)
    index = indexed(spark, dumps, none)
    assert index.count() == 0
    nothing = spark.createDataFrame([], "dump_file_id bigint, dump_idx bigint")
    assert offsets.read_lines_by_offset(spark, dumps, none, index, nothing).count() == 0


def test_offsets_go_into_the_store(spark, dumps, tmp_path):
    catalog, store = catalog_of(spark, dumps), Store(spark, str(tmp_path / "store"))
    store.replace("line_offset", offsets.line_offsets(spark, dumps, catalog))
    every = src.read_lines(spark, dumps, catalog)
    assert keyed(offsets.read_lines_by_offset(spark, dumps, catalog, store.read("line_offset"), every)) == keyed(every)


def packed_text(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f.endswith(".txt.gz"))


def odd_lines(spark):
    """Names that Spark escapes, empty and null lines, wide letters, repeated numbers, files of one line and of many members."""
    rows = [(1, "a name+with %20:signs/é.ndjson", i, None if i == 5 else "" if i % 9 == 0 else f"Zürich {i} \U0001f600\r") for i in range(300)]
    rows += [(2, "one", 0, "only")] + [(3, "twice", i // 2, "same") for i in range(130)]
    return spark.createDataFrame(rows, "dump_file_id bigint, file_name string, dump_idx bigint, value string")


def test_members_are_read_by_their_ranges(spark, tmp_path):
    plain, target = str(tmp_path / "plain"), str(tmp_path / "members")
    archive.write_files(odd_lines(spark), plain)
    archive.pack(odd_lines(spark), target, ranged=True)
    catalog = stage(src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, target, packed=True)), "catalog")
    every = src.read_lines(spark, target, catalog, packed=True)
    assert keyed(every) == keyed(src.read_lines(spark, plain, catalog, packed=True))
    index = stage(offsets.line_offsets(spark, target, catalog, packed=True), "offsets")
    rows = index.collect()
    # Every line lies in a member that has offsets; the ranges make up the files.
    assert sum(r.lines for r in rows) == every.count() == 431 and max(r.lines for r in rows) == 64
    assert sum(r.stop - r.start for r in rows) == packed_text(target)
    assert keyed(offsets.read_lines_by_offset(spark, target, catalog, index, every, packed=True)) == keyed(every)
    some = every.where("dump_idx % 63 = 0").unionByName(every.where("dump_idx % 63 = 0"))
    assert keyed(offsets.read_lines_by_offset(spark, target, catalog, index, some, packed=True)) == keyed(every.where("dump_idx % 63 = 0"))


def test_members_of_other_writers(spark, tmp_path):
    """Members that begin in the middle of a stretch are indexed; those that do not hold whole lines, or too many, are not."""
    texts = {
        "short": [b"".join(b"%d\n" % i for i in range(n)) for n in (10, 64, 1, 60)] + [b"", b"last"],
        "torn": [b"a\nb", b"c\n"],
        "long": [b"x\n" * 65],
        "marked": [b"\xef\xbb\xbfx\n", b"y\n"],
    }
    for name, members in texts.items():
        (tmp_path / f"{name}.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    catalog = catalog_of(spark, str(tmp_path))
    index = indexed(spark, str(tmp_path), catalog)
    assert sorted((r.file_name, r.first_idx, r.lines) for r in index.collect()) == [
        ("short.gz", 0, 10), ("short.gz", 10, 64), ("short.gz", 74, 1), ("short.gz", 75, 60), ("short.gz", 135, 1)
    ]
    every = src.read_lines(spark, str(tmp_path), catalog)
    assert keyed(offsets.read_lines_by_offset(spark, str(tmp_path), catalog, index, every)) == keyed(every)
    one = every.where("file_name = 'short.gz' and dump_idx in (70, 74, 75)")
    assert keyed(offsets.read_lines_by_offset(spark, str(tmp_path), catalog, index, one)) == keyed(one)


def test_lines_by_offset_are_not_stored_plain(spark, sf):
    folder = corpus.dump_folder(spark, sf, ranged=True)
    catalog = stage(src.upsert_catalog(src.empty_catalog(spark), src.list_files(spark, folder, packed=True)), "catalog")
    index = offsets.line_offsets(spark, folder, catalog, packed=True)
    lines = src.read_lines(spark, folder, catalog, packed=True)
    assert index.agg(F.sum("lines")).first()[0] == lines.count() == corpus.lines(spark, sf).count()
    assert packed_text(folder) * 5 < lines.agg(F.sum(F.octet_length("value"))).first()[0]


def test_members_of_nothing(spark, tmp_path):
    archive.pack(odd_lines(spark).limit(0), str(tmp_path / "none"), ranged=True)
    assert src.list_files(spark, str(tmp_path / "none"), packed=True).count() == 0


def test_text_stays_where_it_is_when_many_lines_are_wanted(spark, dumps):
    """Wanted positions beyond the planner's limit for broadcasts, as of a large dump, must not get all lines shuffled."""
    lines = numbered(spark, dumps)
    keys = lines.where("dump_idx % 3 = 0").select("dump_file_id", "dump_idx")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        found = src.wanted_lines(lines, keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert found.count() == keys.count() > 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

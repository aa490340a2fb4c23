"""Sparse byte offsets of dump lines: a line is read without reading its file."""

from __future__ import annotations

import zlib
from itertools import accumulate
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.article import article_id
from ..schemas import LINE_OFFSET
from ..session import stage
from .lines import MASK_BITS, number_lines, position_masks, read_lines_at, scan_lines

# Lines between two offsets: what is read for one wanted line.
STRETCH_LINES = 1 << MASK_BITS
# Bytes that one task reads, plain and packed; largest gap that one read bridges, and its largest size.
RANGE_BYTES, PACKED_BYTES, GAP_BYTES, READ_BYTES = 128 << 20, 8 << 20, 64 << 10, 8 << 20
_CHUNK = 64 << 10

_FOUND = "dump_file_id bigint, file_name string, dump_idx bigint, raw binary"
_ARROW = pa.schema([("dump_file_id", pa.int64()), ("file_name", pa.string()), ("dump_idx", pa.int64()), ("raw", pa.binary())])


_MEMBER = LINE_OFFSET.replace("stretch bigint, ", "")


def _packed() -> Column:
    return F.endswith("file_path", F.lit(".gz"))


def line_offsets(spark: SparkSession, path, catalog: DataFrame, packed: bool = False, only: list[str] | None = None) -> DataFrame:
    """LINE_OFFSET rows of the catalogued dump files: the bytes of each stretch of STRETCH_LINES lines.

    Of plain files only lengths are shuffled, already summed by stretch; a running sum over the stretches of one
    physical file gives the offsets. A file whose lines do not add up to its size (compressed otherwise, or
    with a byte order mark) has no offsets that a reader could use and is left out. A gzip file made of
    members of whole lines, STRETCH_LINES at most, has a row for each member: the bytes of the member.
    """
    marked = scan_lines(spark, path, packed, only)
    lines = number_lines(marked, catalog, keep=("file_path", "file_size", "written"))
    stretch = F.call_function("div", "dump_idx", F.lit(STRETCH_LINES)).alias("stretch")
    sums = lines.groupBy("dump_file_id", "file_name", "file_path", stretch).agg(
        F.min("dump_idx").alias("first_idx"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.octet_length("value") + F.lit(1).cast("bigint")).alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.max("written").alias("modified"),
    )
    sums = stage(sums, "line-sums")
    own = Window.partitionBy("file_path")
    placed = sums.where(~_packed()).withColumns({
        "stop": F.sum("bytes").over(own.orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)),
        "all_bytes": F.sum("bytes").over(own),
    })
    # The last line may lack its end.
    fits = (F.col("all_bytes") - F.col("file_size")).isin(0, 1)
    rows = placed.where(fits).withColumn("start", F.col("stop") - F.col("bytes"))
    names = [field.split()[0] for field in LINE_OFFSET.split(", ")]
    return rows.select(*names).unionByName(_member_offsets(spark, path, sums.where(_packed())).select(*names))


def _member_offsets(spark: SparkSession, path, sums: DataFrame) -> DataFrame:
    """The members of the gzip files that have line counts in ``sums``; every file is unpacked once, as a stream."""
    first = sums.groupBy("dump_file_id", "file_name", "file_path", "file_size", "modified").agg(
        F.min("first_idx").alias("first_idx"), F.sum("lines").alias("lines")
    )
    files = stage(unchanged(spark, path, first), "packed-files")
    total = files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")).first()
    tasks = total.bytes // PACKED_BYTES + 1
    spread = files.coalesce(1) if tasks == 1 else files.repartition(tasks, "file_path")
    columns = [field.split()[0] for field in _MEMBER.split(", ")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", zone), *[pa.int64()] * 4]
    schema = pa.schema(list(zip(columns, types, strict=True)))

    def index(batches):
        for batch in batches:
            own = [batch.column(c) for c in ("dump_file_id", "file_name", "file_path", "file_size", "modified")]
            for i, row in enumerate(batch.select(["plain_path", "first_idx", "lines"]).to_pylist()):
                members = _members(row["plain_path"], row["lines"])
                if not members:
                    continue
                counts, starts, stops = zip(*members, strict=True)
                firsts = [row["first_idx"] + n for n in accumulate(counts, initial=0)][:-1]
                same = [column.take(pa.array([i] * len(members))) for column in own]
                yield pa.RecordBatch.from_arrays([*same, pa.array(firsts, pa.int64()), *[pa.array(c, pa.int64()) for c in (counts, starts, stops)]], schema=schema)

    stretch = F.call_function("div", "first_idx", F.lit(STRETCH_LINES))
    return spread.mapInArrow(index, _MEMBER).withColumn("stretch", stretch)


def _members(path: str, lines: int) -> list[tuple[int, int, int]]:
    """Lines, start and stop of each member of a gzip file; none if a member does not begin with a line, or is
    larger than a stretch, or if the members have not as many lines as the file."""
    found, at, start, count, last, begins = [], 0, 0, 0, b"\n", True
    stream = zlib.decompressobj(31)
    with _opened(path) as file:
        while chunk := file.read(_CHUNK):
            while chunk:
                try:
                    text = stream.decompress(chunk)
                except zlib.error:
                    return []
                at += len(chunk) - len(stream.unused_data)
                chunk = stream.unused_data
                if text:
                    if begins and (last != b"\n" or (not found and text.startswith(b"\xef"))):
                        return []
                    count, last, begins = count + text.count(b"\n"), text[-1:], False
                if count > STRETCH_LINES:
                    return []
                if stream.eof:
                    if not begins:
                        found.append((count, start, at))
                    stream, start, count, begins = zlib.decompressobj(31), at, 0, True
    if start != at:
        return []
    # The last line may lack its end.
    if found and last != b"\n":
        found[-1] = (found[-1][0] + 1, *found[-1][1:])
    return found if all(0 < n <= STRETCH_LINES for n, _, _ in found) and sum(n for n, _, _ in found) == lines else []


def unchanged(spark: SparkSession, path, offsets: DataFrame) -> DataFrame:
    """Offsets of files that still have the size and time they were indexed with, and the files' plain paths."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("path").alias("plain_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"),
    )
    return offsets.join(listed, ["file_path", "file_size", "modified"])


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it. Stores that Arrow cannot reach have to be mounted."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _opened(path: str):
    """A file that can be read from any place."""
    system, inner = located(path)
    return system.open_input_file(inner)


def _runs(batches):
    """Rows whose ranges are near to each other in one file, so that one read serves them."""
    run = []
    for batch in batches:
        for row in batch.to_pylist():
            near = run and row["plain_path"] == run[0]["plain_path"] and row["start"] - run[-1]["stop"] <= GAP_BYTES
            if run and not (near and row["stop"] - run[0]["start"] <= READ_BYTES):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _read_ranges(batches):
    path, file = None, None
    for run in _runs(batches):
        if run[0]["plain_path"] != path:
            if file is not None:
                file.close()
            path = run[0]["plain_path"]
            file = _opened(path)
        begin = run[0]["start"]
        data = file.read_at(min(run[-1]["stop"], run[0]["file_size"]) - begin, begin)
        for row in run:
            raw = data[row["start"] - begin : row["stop"] - begin]
            if path.endswith(".gz"):
                try:
                    raw = zlib.decompress(raw, 31)
                except zlib.error:
                    raw = b""
            lines = raw.removesuffix(b"\n").split(b"\n")
            if len(lines) != row["lines"]:
                raise ValueError(f"{path} changed while it was read; index it again")
            wanted = row["wanted"]
            yield pa.RecordBatch.from_pydict(
                {
                    "dump_file_id": [row["dump_file_id"]] * len(wanted),
                    "file_name": [row["file_name"]] * len(wanted),
                    "dump_idx": wanted,
                    "raw": [lines[i - row["first_idx"]] for i in wanted],
                },
                _ARROW,
            )
    if file is not None:
        file.close()


def _positions(mask: str) -> Column:
    """The line numbers that the bits of a mask stand for."""
    return F.expr(
        f"transform(filter(sequence(0, {STRETCH_LINES - 1}), b -> (shiftright({mask}, b) & 1) = 1), b -> shiftleft(_stretch, {MASK_BITS}) + b)"
    )


def read_lines_by_offset(
    spark: SparkSession, path, catalog: DataFrame, offsets: DataFrame, articles: DataFrame, packed: bool = False
) -> DataFrame:
    """What :func:`read_lines_at` returns, from byte ranges: the stretches that hold a wanted line and no others.

    Positions without usable offsets (files never indexed, changed since, or compressed otherwise) are
    scanned as before, so the result does not depend on the index. Articles without a position
    have no line; repeated ones have it once. Positions travel as bit masks, one row for 64 lines.
    """
    keys = articles.where("dump_idx is not null and dump_file_id is not null").select("dump_file_id", F.col("dump_idx").cast("bigint"))
    masks = position_masks(keys)
    # A member need not begin where a stretch does: a range stands in each stretch that it reaches into.
    last = F.col("first_idx") + F.col("lines") - 1
    ranges = unchanged(spark, path, offsets).drop("stretch").withColumn(
        "_stretch", F.explode(F.sequence(F.shiftright("first_idx", MASK_BITS), F.shiftright(last, MASK_BITS)))
    )
    low = F.greatest(F.col("first_idx"), F.shiftleft("_stretch", MASK_BITS))
    high = F.least(last, F.shiftleft("_stretch", MASK_BITS) + (STRETCH_LINES - 1))
    ranges = ranges.withColumn("_low", (low % STRETCH_LINES).cast("int")).withColumn("_n", (high - low + 1).cast("int"))
    covered = F.expr(f"shiftleft(shiftrightunsigned(-1L, {STRETCH_LINES} - _n), _low)")
    place = [c for c in ranges.columns if c not in ("_stretch", "_low", "_n")]
    met = masks.join(ranges, ["dump_file_id", "_stretch"], "left").withColumn(
        "_held", F.coalesce(F.col("_mask").bitwiseAND(covered), F.lit(0).cast("bigint"))
    )
    met = stage(met.select("_stretch", "_mask", "_held", *place), "met-ranges")
    wanted = F.array_sort(F.array_distinct(F.flatten(F.collect_list(_positions("_held")))))
    found = stage(met.where("_held <> 0").groupBy(*place).agg(wanted.alias("wanted")), "line-ranges")
    rest = met.groupBy("dump_file_id", "_stretch").agg(F.expr("max(_mask) & ~bit_or(_held)").alias("_mask")).where("_mask <> 0")
    rest = rest.select("dump_file_id", F.explode(_positions("_mask")).alias("dump_idx"))
    size = F.col("stop") - F.col("start")
    total = found.agg(
        F.coalesce(F.sum(F.when(~_packed(), size)), F.lit(0)).alias("plain"), F.coalesce(F.sum(F.when(_packed(), size)), F.lit(0)).alias("packed")
    ).first()
    # The rows are small, but what they stand for is not: tasks are counted by the bytes to read.
    tasks = total.plain // RANGE_BYTES + total.packed // PACKED_BYTES + 1
    spread = found.coalesce(1) if tasks == 1 else found.repartitionByRange(tasks, "plain_path", "start")
    # One file's ranges follow each other in a task, which opens it once.
    read = spread.sortWithinPartitions("plain_path", "start").mapInArrow(_read_ranges, _FOUND).select(
        article_id(F.col("dump_file_id"), F.col("dump_idx")).alias("article_id"),
        "dump_file_id", "file_name", "dump_idx", F.col("raw").cast("string").alias("value"),
    )
    if rest.isEmpty():
        return read
    return read.unionByName(read_lines_at(spark, path, catalog, rest, packed))

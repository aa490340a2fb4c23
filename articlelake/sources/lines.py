"""Dump files: catalog, line scan with positions, resume and point reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.article import article_id
from ..schemas import DUMP_FILE
from ..session import numbered, stage

# Split offsets broadcast at once: about 150 bytes each.
SPLITS_A_SHARE = 200_000
# Lines of a file that one row of wanted positions stands for: the bits of a long, as a power of two.
MASK_BITS = 6
# Rows of wanted positions that are broadcast, about 100 bytes each in memory: of 64 million lines, if all are wanted.
MASKS_BROADCAST = 1 << 20


def list_files(spark: SparkSession, path, packed: bool = False) -> DataFrame:
    """File names, sizes and times, from the listing alone: no content is read.

    ``packed`` reads the layout written by :func:`articlelake.sources.archive.write_files`,
    one folder ``file_name=<name>`` per dump file.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(path).select("path", "length", "modificationTime")
    if packed:
        # Folder names escape special characters; a plus sign is itself.
        folder = F.regexp_extract("path", r"file_name=([^/]+)/", 1)
        name = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    else:
        name = F.element_at(F.split("path", "/"), -1)
    return (
        files.select(name.alias("file_name"), "length", "modificationTime")
        .groupBy("file_name")
        .agg(F.sum("length").alias("size"), F.max("modificationTime").alias("modified"))
    )


def upsert_catalog(existing: DataFrame, listed: DataFrame) -> DataFrame:
    """Refresh known files, number new ones after the highest known id in name order."""
    merged = existing.alias("e").join(listed.alias("n"), "file_name", "full_outer").select(
        "file_name",
        "id",
        F.coalesce("n.size", "e.size").alias("size"),
        F.coalesce("n.modified", "e.modified").alias("modified"),
    )
    known = merged.where("id is not null")
    highest = F.coalesce(existing.agg(F.max("id")).scalar(), F.lit(0))
    fresh = numbered(merged.where("id is null").drop("id"), ["file_name"], "_rank").withColumn("id", highest + F.col("_rank") + 1)
    columns = ["id", "file_name", "size", "modified"]
    return known.select(*columns).unionByName(fresh.select(*columns))


def uncatalogued(listed: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listed files that :func:`read_lines` leaves out because the catalog does not know them."""
    return listed.join(catalog.select("file_name"), "file_name", "left_anti")


def empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DUMP_FILE)


def scan_lines(spark: SparkSession, path, packed: bool = False, only: list[str] | None = None) -> DataFrame:
    """Raw lines with the marks that :func:`number_lines` needs. Blank lines are kept.

    ``only`` names the dump files to read; the others are dropped from the file listing.
    """
    reader = spark.read.option("lineSep", "\n")
    if packed:
        reader = reader.schema("value string, file_name string")
    text = reader.text(path)
    if only is not None:
        text = text.where((F.col("file_name") if packed else F.col("_metadata.file_name")).isin(only))
    return mark_lines(text, packed)


def mark_lines(text: DataFrame, packed: bool = False) -> DataFrame:
    name = F.col("file_name") if packed else F.col("_metadata.file_name")
    return text.select(
        name.alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("written"),
        F.col("_metadata.file_size").alias("file_size"),
        "value",
    )


def number_lines(
    marked: DataFrame, catalog: DataFrame, earlier: DataFrame | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(dump_file_id, file_name, dump_idx, value)``: 0-based line number within each dump file.

    Pass one counts lines per scan split (the text column is pruned away); the counts are
    accumulated per file, giving each split its first line number and its file's id. Pass two
    adds the position inside the split. A file of any size is numbered by all its splits in
    parallel, where a window over the file would need one task for the whole file, and no line
    is moved: split offsets are handled in shares of the files, each small enough to broadcast.

    ``earlier(file_name, lines)`` says how many lines of a file came before (in parts that are not
    scanned); its numbers go on from there. Files that the catalog does not name are left out.
    ``keep`` names columns of ``marked`` to pass on.
    Both passes must see the same splits. Should the layout differ after all (see
    ``spark.sql.files.minPartitionNum``), the query fails instead of misnumbering.
    """
    seq = F.monotonically_increasing_id()
    splits = (
        marked.select("file_name", "file_path", "block_start", "written", seq.alias("seq"))
        .groupBy("file_name", "file_path", "block_start")
        .agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"), F.min("written").alias("written"))
    )
    # Parts of one packed file carry the name of the job that wrote them and growing numbers, padded
    # to five digits. Jobs come in the order of their first part's time.
    job = F.regexp_extract("file_path", r"part-\d+-([0-9a-f-]{36})", 1)
    splits = splits.withColumn("job", job).withColumn(
        "job_time", F.min("written").over(Window.partitionBy("file_name", "job"))
    )
    before = (
        Window.partitionBy("file_name").orderBy("job_time", "job", F.length("file_path"), "file_path", "block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    if earlier is None:
        known = splits.withColumn("lines", F.lit(0))
    else:
        known = splits.join(earlier.select("file_name", "lines"), "file_name", "left")
    ids = catalog.select(F.col("id").alias("dump_file_id"), "file_name")
    offsets = stage(
        known.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)) + F.coalesce("lines", F.lit(0)))
        .join(ids, "file_name", "left")
        .drop("lines", "written", "job", "job_time"),
        "splits",
    )
    at = F.col("seq") - F.col("first_seq")
    counted = marked.withColumn("seq", seq)
    misread = F.raise_error(F.lit("scan splits changed between passes; pin spark.sql.files.minPartitionNum"))
    result = None
    # One share of the files up to 25 TB of default splits; a file is opened for its share only.
    shares = offsets.count() // SPLITS_A_SHARE + 1
    for share in range(shares):
        here = F.pmod(F.xxhash64("file_name"), F.lit(shares)) == share
        own = F.broadcast(offsets.where(here).drop("file_name").withColumn("counted", F.lit(True)))
        joined = counted.where(here).join(own, ["file_path", "block_start"], "left")
        # A split that was not counted must fail, not pass for a file without an id.
        lines = joined.where(F.when(F.col("counted").isNull(), True).otherwise(F.col("dump_file_id").isNotNull())).select(
            "dump_file_id",
            "file_name",
            F.when((at >= 0) & (at < F.col("n")), F.col("before") + at).otherwise(misread.cast("bigint")).alias("dump_idx"),
            "value",
            *keep,
        )
        result = lines if result is None else result.unionByName(lines)
    return result


def read_lines(
    spark: SparkSession, path, catalog: DataFrame, packed: bool = False, only: list[str] | None = None
) -> DataFrame:
    """``(dump_file_id, file_name, dump_idx, value)`` of the catalogued files."""
    return number_lines(scan_lines(spark, path, packed, only), catalog)


def read_pending_lines(
    spark: SparkSession, path, catalog: DataFrame, articles: DataFrame, packed: bool = False
) -> DataFrame:
    """Lines not ingested yet. Files before the high-water mark, and files that the catalog does
    not name, are not opened. The names are no more than the file listing the scan itself holds."""
    names = [r.file_name for r in pending_files(catalog, articles).select("file_name").collect()]
    return resume_lines(read_lines(spark, path, catalog, packed, names), articles)


def read_lines_at(
    spark: SparkSession, path, catalog: DataFrame, articles: DataFrame, packed: bool = False
) -> DataFrame:
    """The stored line of each given article; only the files that hold one are opened."""
    held = articles.where("dump_file_id is not null").select(F.col("dump_file_id").alias("id")).distinct()
    names = [r.file_name for r in catalog.join(held, "id", "left_semi").select("file_name").collect()]
    return lines_at(read_lines(spark, path, catalog, packed, names), articles)


def lines_per_file(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"))


def high_water(articles: DataFrame) -> DataFrame:
    """One row: last ingested file and line; file 1, line -1 when there is none."""
    last = articles.where("dump_file_id is not null").agg(F.max(F.struct("dump_file_id", "dump_idx")).alias("m"))
    return last.select(
        F.coalesce("m.dump_file_id", F.lit(1)).cast("bigint").alias("dump_file_id"),
        F.coalesce("m.dump_idx", F.lit(-1)).cast("bigint").alias("dump_idx"),
    )


def pending_files(catalog: DataFrame, articles: DataFrame) -> DataFrame:
    """Catalog rows from the high-water file on, in id order."""
    mark = high_water(articles).select("dump_file_id").scalar()
    return catalog.where(F.col("id") >= mark).orderBy("id")


def resume_lines(lines: DataFrame, articles: DataFrame) -> DataFrame:
    """Lines after the high-water mark. The mark is a one-row subquery."""
    mark = high_water(articles)
    file, idx = mark.select("dump_file_id").scalar(), mark.select("dump_idx").scalar()
    return lines.where(
        (F.col("dump_file_id") > file) | ((F.col("dump_file_id") == file) & (F.col("dump_idx") > idx))
    )


def position_masks(keys: DataFrame) -> DataFrame:
    """``(dump_file_id, _stretch, _mask)``: the positions of ``keys(dump_file_id, dump_idx)``, one bit for each."""
    # Shifts and masks round negative positions down, too, where a division would not.
    stretch = F.shiftright("dump_idx", MASK_BITS)
    bit = F.expr(f"shiftleft(1L, cast(dump_idx & {(1 << MASK_BITS) - 1} as int))")
    return keys.groupBy("dump_file_id", stretch.alias("_stretch")).agg(F.bit_or(bit).alias("_mask"))


def wanted_lines(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Lines whose position is in ``keys(dump_file_id, dump_idx)``.

    Positions are gathered into bit masks, one row for each stretch of 64 lines of a file. A line meets one
    row at most and tests one bit of it, so the time does not depend on how many lines of its file are wanted, or
    how they lie. The rows are narrow; up to MASKS_BROADCAST of them are broadcast against the scan and the text stays
    where it is. The planner's own limit is meant for either side of a join: past it, all lines would be shuffled.
    """
    masks = stage(position_masks(keys), "wanted-lines")
    if masks.count() <= MASKS_BROADCAST:
        masks = F.broadcast(masks)
    bit = f"cast(dump_idx & {(1 << MASK_BITS) - 1} as int)"
    joined = lines.withColumn("_stretch", F.shiftright("dump_idx", MASK_BITS)).join(masks, ["dump_file_id", "_stretch"])
    return joined.where(F.expr(f"(shiftright(_mask, {bit}) & 1) = 1")).select(*lines.columns)


def lines_at(lines: DataFrame, articles: DataFrame) -> DataFrame:
    """The stored line of each given article, with its ``article_id``."""
    found = wanted_lines(lines, articles.where("dump_file_id is not null").select("dump_file_id", "dump_idx"))
    return found.select(
        article_id(F.col("dump_file_id"), F.col("dump_idx")).alias("article_id"), "dump_file_id", "file_name", "dump_idx", "value"
    )

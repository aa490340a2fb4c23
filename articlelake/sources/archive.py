"""Dump archives (tar.gz of line files) and packed line files."""

from __future__ import annotations

import re
import tarfile
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import made_folder, shuffles_deleted
from .lines import read_lines
from .offsets import STRETCH_LINES, located

BATCH_BYTES = 16 << 20
_SCHEMA = "archive string, file_name string, dump_idx bigint, value string"


def _members(batches):
    """Stream the members of each archive as line batches of bounded size."""
    names = ["archive", "file_name", "dump_idx", "value"]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, inner = pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(inner, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
                for member in tar:
                    if not member.isfile():
                        continue
                    lines, size, first = [], 0, 0
                    for line in tar.extractfile(member):
                        lines.append(line.decode("utf-8", "replace").rstrip("\n"))
                        size += len(line)
                        if size >= BATCH_BYTES:
                            yield _batch(names, path, member.name, first, lines)
                            first, lines, size = first + len(lines), [], 0
                    if lines:
                        yield _batch(names, path, member.name, first, lines)


def _batch(names, path, member, first, lines):
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * n, pa.string()),
            pa.array([member] * n, pa.string()),
            pa.array(range(first, first + n), pa.int64()),
            pa.array(lines, pa.string()),
        ],
        names=names,
    )


def read_archives(spark: SparkSession, path) -> DataFrame:
    """Lines of all regular members of the ``*.tar.gz`` files under ``path``.

    One task per archive: a gzip stream has no entry points. The archives are streamed,
    never held in memory, and must be on storage that Arrow can open on the executors.
    """
    archives = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar.gz")
        .load(path).select("path")
    )
    spread = archives.repartition(max(1, len(archives.inputFiles())))
    return spread.mapInArrow(_members, _SCHEMA)


def read_dump(spark: SparkSession, path, catalog: DataFrame, kind: str = "files") -> DataFrame:
    """``(dump_file_id, file_name, dump_idx, value)`` of catalogued dump files in any of the three layouts:
    plain ``files``, ``packed`` folders, or tar ``archives`` whose members are the files."""
    if kind in ("files", "packed"):
        return read_lines(spark, path, catalog, packed=kind == "packed")
    if kind != "archives":
        raise ValueError(f"no such layout: {kind}")
    ids = catalog.select(F.col("id").alias("dump_file_id"), "file_name")
    return read_archives(spark, path).join(ids, "file_name").select("dump_file_id", "file_name", "dump_idx", "value")


def only_new_files(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Drop members whose name is already present."""
    names = known.select("file_name").distinct()
    return lines.join(names, "file_name", "left_anti")


def _ordered(lines: DataFrame, value: Column | None) -> DataFrame:
    ordered = lines.repartitionByRange("file_name", "dump_idx").sortWithinPartitions("file_name", "dump_idx")
    return ordered.select("file_name", F.col("value") if value is None else value.alias("value"))


def write_files(lines: DataFrame, path: str, compress: bool = False, mode: str = "append", value: Column | None = None) -> None:
    """One folder ``file_name=<name>`` per dump file, lines in ``dump_idx`` order.

    Lines are range partitioned, so a very large file becomes several consecutive parts
    written by several tasks; part numbers keep the line order. ``value`` makes the text of a line from the
    columns of ``lines`` where it is written, so that only those columns are shuffled and sorted.
    """
    writer = _ordered(lines, value).write.mode(mode).partitionBy("file_name")
    if compress:
        writer = writer.option("compression", "gzip")
    with shuffles_deleted(lines.sparkSession):
        writer.text(path)


def _folder_name(file_name: str | None) -> str:
    """A partition folder as Spark names it."""
    if not file_name:
        return "file_name=__HIVE_DEFAULT_PARTITION__"
    return "file_name=" + re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", file_name)


def _gzip(lines: list[bytes | None]) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"".join((line or b"") + b"\n" for line in lines)) + packer.flush()


def write_members(lines: DataFrame, path: str, value: Column | None = None) -> None:
    """What :func:`write_files` writes with ``compress``, as gzip members of STRETCH_LINES lines each.

    Any reader of gzip files reads them; a member is also read by its byte range alone, see
    :func:`articlelake.sources.offsets.line_offsets`. A part is written under a hidden name, which readers
    pass over, and renamed when it is complete, so a task that fails leaves no half of one.
    """
    root, job = made_folder(lines.sparkSession, path), str(uuid.uuid4())

    def write(batches):
        system, base = located(root)
        part = f"part-{TaskContext.get().partitionId():05d}-{job}.txt.gz"
        name, folder, hidden, out, held = None, "", "", None, []

        def close():
            if held:
                out.write(_gzip(held))
                held.clear()
            out.close()
            system.move(hidden, f"{folder}/{part}")

        for batch in batches:
            for file_name, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if out is None or file_name != name:
                    if out is not None:
                        close()
                    name, folder = file_name, f"{base}/{_folder_name(file_name)}"
                    system.create_dir(folder, recursive=True)
                    hidden = f"{folder}/.{part}-{uuid.uuid4().hex}"
                    out = system.open_output_stream(hidden, compression=None)
                held.append(line)
                if len(held) == STRETCH_LINES:
                    out.write(_gzip(held))
                    held.clear()
        if out is not None:
            close()
        yield from ()

    _ordered(lines, value).mapInArrow(write, "done boolean").write.format("noop").mode("overwrite").save()


def unpack(spark: SparkSession, archives: str, target: str, known: DataFrame | None = None) -> None:
    """Extract members not yet present in ``target``. Lines keep the order in which the
    task reads them, so no line is shuffled."""
    lines = read_archives(spark, archives)
    if known is not None:
        lines = only_new_files(lines, known)
    (
        lines.sortWithinPartitions("file_name", "dump_idx").select("file_name", "value")
        .write.mode("append").partitionBy("file_name").text(target)
    )


def pack(lines: DataFrame, target: str, value: Column | None = None, ranged: bool = False) -> None:
    """Compress each dump file; originals stay. ``value`` as in :func:`write_files`; ``ranged`` packs in members
    that can be read by themselves."""
    if ranged:
        write_members(lines, target, value)
    else:
        write_files(lines, target, compress=True, value=value)

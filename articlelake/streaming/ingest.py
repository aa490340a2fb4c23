"""Incremental ingest of arriving dump files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import ingest
from ..session import stage
from ..sources.lines import mark_lines, number_lines, upsert_catalog
from ..sources.store import Store


def ingest_stream(spark: SparkSession, path: str, store: Store, checkpoint: str, as_of: datetime, packed: bool = False):
    """Start a query that ingests every file not seen before, then stops.

    The checkpoint remembers files. A file is never divided between micro-batches, but the parts of
    a packed dump file may arrive in several: the store keeps the lines of every part, and
    numbers go on after those of earlier parts. The splits of a batch are fixed, so the two
    passes of the numbering agree. Replaying a batch after a failure adds nothing: the lines of its
    own parts do not count as earlier, and its titles are stored already.
    """
    reader = spark.readStream.option("lineSep", "\n")
    reader = reader.schema("value string, file_name string" if packed else "value string")
    source = mark_lines(reader.text(path), packed)

    def batch(marked, _batch_id):
        batch_store = Store(marked.sparkSession, store.root)
        parts = stage(marked.groupBy("file_name", "file_path").agg(F.count(F.lit(1)).alias("lines")), "parts")
        names = parts.select("file_name").distinct().selectExpr(
            "file_name", "cast(null as bigint) as size", "cast(null as timestamp) as modified"
        )
        batch_store.replace("dump_file", upsert_catalog(batch_store.read("dump_file"), names))
        others = batch_store.read("dump_part").join(parts.select("file_path"), "file_path", "left_anti")
        earlier = others.groupBy("file_name").agg(F.sum("lines").alias("lines"))
        lines = number_lines(marked, batch_store.read("dump_file"), earlier)
        batch_store.append("article", ingest(lines, batch_store.read("article"), as_of))
        batch_store.append("dump_part", parts.join(batch_store.read("dump_part").select("file_path"), "file_path", "left_anti"))

    return (
        source.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

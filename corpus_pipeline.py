"""Training-data pipeline: quality, toxicity, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` with ``docs`` as its predecessor wrote it; models are
learned from the labelled rows of ``sf_dir``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm import packing, quality, simhash, toxicity
from articlelake.llm.common import staged, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) >= 0.7)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key for each row: its id (those without one last) and its place in the files, which is the
    same however a scan is split. Rows that come from no file are written first."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = staged(docs, "pipeline-rows")
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    id_ = [F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id")]
    return docs.withColumn("_row_key", F.struct(*id_, *place))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, as the SimHash operator finds them with its own shingles
    and radius: that with the smallest doc_id.

    Rows are told apart by their place, so of rows that repeat that id, or have none, one stays as well. The
    keys that go are few and narrow; texts meet them in an anti join that the planner may broadcast.
    """
    placed = _placed(docs)
    found = simhash.near_duplicates(placed.select(F.col("_row_key").alias("doc_id"), "text"))
    losers = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_row_key"))
    return placed.join(losers, "_row_key", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [("quality", keep_quality), ("toxicity", keep_clean), ("near-dedup", keep_distinct), ("packing", pack)]

# Learned scores and tokenizer ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

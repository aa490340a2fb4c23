"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, fingerprints, graph_search, hard_negatives, language, lexical_search, license_scan, packing, quality
from . import sentencepiece_fst, simhash, toxicity, warc
from .common import fold, table


def held_out(folds: int, held: int) -> Column:
    """Whether a row is kept from learning; false for rows without an id, which are not learned from either."""
    return F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out")


def op1_license(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.report(license_scan.scan(table(spark, d, "documents")))


def op2_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", held_out(5, 0), "lang_pred", "score")


def op3_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentencepiece_fst.round_trip(table(spark, d, "documents"))


def op4_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.edit_report(table(spark, d, "documents"))


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = quality.score_quality(docs, quality.fit(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out(4, 2), "score", "predicted")


def op6_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, d, "embeddings"))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out(5, 0), "score", "predicted")


def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, d, "documents")))


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    found = warc.archive_pages(table(spark, d, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical(spark: SparkSession, d: str) -> DataFrame:
    return lexical_search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op12_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return graph_search.nearest(table(spark, d, "embeddings"))


def op13_negatives(spark: SparkSession, d: str) -> DataFrame:
    return hard_negatives.mine(table(spark, d, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license": op1_license,
    "op2_language": op2_language,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_fingerprints": op4_fingerprints,
    "op5_quality": op5_quality,
    "op6_embeddings": op6_embeddings,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_lexical": op11_lexical,
    "op12_neighbours": op12_neighbours,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = {
    "op1_license": license_scan.oracle_sql(),
    "op10_warc": warc.oracle_sql(),
    "op11_lexical": lexical_search.oracle_sql(),
    "op13_negatives": hard_negatives.oracle_sql(),
}

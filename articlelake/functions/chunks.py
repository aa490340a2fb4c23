"""Splitting long text into stored pieces and joining it again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: characters per stored piece.
CHUNK_CHARS = 14000


def text_chunks(text: Column, size: int = CHUNK_CHARS) -> Column:
    """Array of pieces; empty or NULL text gives one empty piece."""
    whole = F.coalesce(text, F.lit(""))
    last = F.greatest(F.ceil(F.length(whole) / size).cast("int"), F.lit(1)) - 1
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(whole, i * size + 1, F.lit(size)),
    )
    return F.when(F.length(whole) <= size, F.array(whole)).otherwise(cut)


def split_overflow(sections: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by its first piece; add ``ext_text_count`` and the ``overflow`` pieces."""
    chunked = sections.withColumn("_chunks", text_chunks(F.col(text)))
    return (
        chunked.withColumn(text, F.col("_chunks")[0])
        .withColumn("ext_text_count", F.size("_chunks") - 1)
        .withColumn("overflow", F.slice("_chunks", F.lit(2), F.greatest(F.size("_chunks") - 1, F.lit(0))))
        .drop("_chunks")
    )


def overflow_rows(split: DataFrame, keys: list[str]) -> DataFrame:
    """One row per overflow piece, numbered from 0."""
    return (
        split.where("ext_text_count > 0")
        .select(*keys, F.posexplode("overflow").alias("count_id", "text"))
    )


def full_text(sections: DataFrame, ext_text: DataFrame, keys: tuple[str, ...] = ("article_id", "section_id")) -> DataFrame:
    """Sections with their complete text, all pieces in order.

    Only sections that have overflow are shuffled; the rest pass through the scan.
    """
    keys = list(keys)
    joined = ext_text.groupBy(*keys).agg(F.expr("listagg(text, '') within group (order by count_id)").alias("_rest"))
    short = sections.where("ext_text_count = 0")
    long = (
        sections.where("ext_text_count > 0")
        .join(joined, keys, "left")
        .withColumn("text", F.concat("text", F.coalesce("_rest", F.lit(""))))
        .drop("_rest")
    )
    return short.unionByName(long)

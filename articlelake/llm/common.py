"""Helpers shared by the operators: tables, bounded training samples, components, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard
from ..session import stage as staged

# Bytes of text that a Python task works on at once.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id has no fold: it is neither learned from nor held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sample_ids(labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, _label): the ``per_class`` ids of smallest hash of each class; and the share of label 1."""
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("_label").alias("_label"))
    )
    picked = [
        known.where(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    share = known.agg(F.avg("_label")).first()[0]
    return picked[0].unionByName(picked[1]), 0.5 if share is None else share


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, text, _label), a bounded number of rows for fitting a classifier, and the share of label 1
    among all labelled rows to learn from (0.5 where there are none).

    Takes the ``per_class`` rows of smallest id hash for label 0 and for label 1 among the rows
    that ``learn`` admits, with their whole texts. Ids labelled twice count as 1 if any label is 1; of rows that
    share an id, one is taken. The ids (at most ``2 * per_class``) are broadcast, so no other text is shuffled.
    """
    ids, share = sample_ids(labels, label, learn, per_class)
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "_label").agg(F.min("text").alias("text")), share


def encoded(array: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of each value of a string or binary array, without building Python strings."""
    wide = array.cast(pa.large_binary()) if pa.types.is_large_string(array.type) else array.cast(pa.binary())
    for value in wide:
        yield value.as_py()


class Forest:
    """Union-find over the rows of one task; keeps only links that join two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self, rows: np.ndarray) -> np.ndarray:
        at = self.parent[rows]
        while True:
            up = self.parent[at]
            if np.array_equal(up, at):
                self.parent[rows] = at
                return at
            at = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join a[k] with b[k] for all k: each round every tree hooks to its smallest neighbour."""
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, first = np.unique(high, return_index=True)
            self.parent[high[first]] = low[first]
            self.links += zip(a[first].tolist(), b[first].tolist(), strict=True)


def connected_components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Alternating large-star and small-star steps: only minima per node are aggregated (map-side
    first) and joined back, so a node with very many links is never gathered in one task, and the
    number of rounds grows with the logarithm of the longest chain. Each round is written to the
    shared folder; only its row count and a sum of hashes reach the driver. Loops are dropped, as
    are links with a null end.
    """
    current = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lows, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = staged(small.unionByName(lows.select("u", F.col("m").alias("v"))).distinct(), label)
        discard(current)
        current = after
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

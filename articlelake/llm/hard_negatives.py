"""Hard negatives by integer inner product, with coordinate pruning inside length buckets.

Rows are ranked by length, with no task holding all, and cut into chunks of rows of like length; a chunk
is cut into length buckets in which every row is at least nine tenths as long as the longest.
A bucket holds one sorted list for each coordinate of its unit vectors. An anchor that asks for rows of
at least a given score skips buckets whose longest row cannot reach it. In the others that score
becomes an angle: with the coordinates on which the anchor's unit vector is largest (its focus), only
rows whose own coordinate lies in a range around it can be that near. The ranges are slices of
the sorted lists; rows in all of them are candidates, and their integer products are computed exactly.

Anchors come in blocks. Every block meets every chunk in a cell of its own, so neither is gathered
anywhere, and a cell returns the best few rows of each question. The first search finds positives
(the asked score is that of the fifth best in a sample, then of the fifth best so far), the second
negatives (half the positive's score, then the third best so far).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import numbered
from .common import staged

POSITIVES, NEGATIVES = 5, 3
# Rows of a chunk; anchors of a block; expected rows of the sample that gives the first bounds; focus coordinates.
CHUNK, BLOCK, SEED_ROWS, FOCUS = 8192, 1024, 4096, 4
# A bucket's rows are at least so long, against its longest.
RATIO = 0.9
# Added to every range: far wider than rounding, so that no row at the bound is missed.
SLACK = 1e-9
# Components beyond this magnitude could carry a sum of products out of 64 bits.
LARGEST = 1 << 20

_ANSWER = ["ask", "key", "vec_id", "score"]


def bounded_rows(vectors: DataFrame, shift_every: int = 7) -> DataFrame:
    """(key, vec_id, label, dim, q) of the rows that take part: labels moved where the id asks for it, components whole numbers."""
    e = F.col("embedding")
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    moved = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & usable)
    return rows.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("vec_id").cast("long").alias("vec_id"),
        moved.cast("long").alias("label"),
        F.size(e).alias("dim"),
        F.transform(e, lambda x: F.floor(x.cast("double") * 256).cast("int")).alias("q"),
    )


class Bucket:
    """Rows of like length, and for each coordinate of their unit vectors its sorted list."""

    def __init__(self, q: np.ndarray, length: np.ndarray, vec_id: np.ndarray, label: np.ndarray, key: np.ndarray):
        self.q, self.longest, self.vec_id, self.label, self.key = q, float(length.max()), vec_id, label, key
        units = q / np.maximum(length, 1e-300)[:, None]
        self.order = np.argsort(units, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(units, self.order.T, 0).T.copy()

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Mask of the rows that may have a product of at least ``least`` with an anchor of this direction and
        length; None if that is any row."""
        if least <= 0:
            return None
        # A row shorter than the longest needs a larger cosine than this.
        cosine = least / (length * self.longest) if length and self.longest else 2.0
        if cosine > 1 + SLACK:
            return np.zeros(len(self.key), bool)
        angle, own = np.arccos(min(1.0, cosine)), np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - SLACK, np.cos(np.maximum(0.0, own - angle)) + SLACK
        kept = None
        for f, least_f, most_f in zip(focus, low, high):
            begin, end = np.searchsorted(self.sorted[f], least_f), np.searchsorted(self.sorted[f], most_f, "right")
            if end - begin < len(self.key):
                inside = np.zeros(len(self.key), bool)
                inside[self.order[f, begin:end]] = True
                kept = inside if kept is None else kept & inside
        return kept


def buckets_of(rows: pa.Table) -> list[Bucket]:
    """Length buckets of a chunk, the longest first."""
    lists = rows["q"].combine_chunks()
    q = lists.flatten().to_numpy().reshape(len(lists), -1)
    # Sums of products are whole numbers; doubles hold them exactly up to 2^53 and multiply faster.
    exact = np.float64 if float(np.abs(q.astype(np.float64)).max()) ** 2 * q.shape[1] < 1 << 53 else np.int64
    length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    q, length, (vec_id, label, key) = q[order].astype(exact), length[order], (rows[c].to_numpy()[order] for c in ("vec_id", "label", "key"))
    found, begin = [], 0
    while begin < len(length):
        end = max(begin + 1, int(np.searchsorted(-length, -RATIO * length[begin], "right")))
        at = slice(begin, end)
        found.append(Bucket(q[at], length[at], vec_id[at], label[at], key[at]))
        begin = end
    return found


def answers(buckets: list[Bucket], anchor: np.ndarray, key: int, label: int, same: bool, questions: list[tuple[int, int, int]], top: int):
    """For each (ask, least, most) the ``top`` rows with a score in that range, as (ask, key, vec_id, score) columns.

    Rows are those of the anchor's label but the anchor itself, or those of other labels.
    """
    length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    unit = anchor / max(length, 1e-300)
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    least = [q[1] for q in questions]
    held = [np.empty((3, 0), np.int64)] * len(questions)
    for bucket in buckets:
        near = bucket.candidates(unit, focus, length, float(min(least)))
        admit = (bucket.label == label) & (bucket.key != key) if same else bucket.label != label
        at = np.flatnonzero(admit if near is None else admit & near)
        if not len(at):
            continue
        # Most rows: the product of all is cheaper than a copy of the rows asked for.
        score = (bucket.q @ anchor)[at] if 4 * len(at) > len(bucket.key) else bucket.q[at] @ anchor
        score = score.astype(np.int64)
        for k, (_, _, most) in enumerate(questions):
            good = at[(score >= least[k]) & (score <= most)]
            if len(good):
                mine = np.concatenate((held[k], np.stack((bucket.key[good], bucket.vec_id[good], score[(score >= least[k]) & (score <= most)]))), 1)
                held[k] = mine[:, np.lexsort((mine[0], mine[1], -mine[2]))[:top]]
                if held[k].shape[1] == top:
                    least[k] = max(least[k], int(held[k][2, -1]))
    for (ask, _, _), best in zip(questions, held):
        yield np.concatenate((np.full((1, best.shape[1]), ask), best))


def ask_all(chunks: DataFrame, asked: DataFrame, same: bool, top: int) -> DataFrame:
    """(ask, key, vec_id, score): the best of every chunk for every question.

    ``chunks`` holds (dim, chunk) and rows; ``asked`` holds (dim, block, ask, anchor, label, q, least, most).
    """
    # Renamed, as the two sides of a cell must not share columns.
    numbers = chunks.select("dim", F.col("chunk").alias("chunk")).distinct()
    blocks = asked.select(F.col("dim").alias("dim"), F.col("block").alias("block")).distinct()
    cell = ["dim", "chunk", "block"]

    def answer(rows: pa.Table, questions: pa.Table) -> pa.Table:
        found = [np.empty((4, 0), np.int64)]
        if rows.num_rows and questions.num_rows:
            buckets = buckets_of(rows)
            by_anchor: dict[int, list] = {}
            for row in questions.sort_by("ask").to_pylist():
                by_anchor.setdefault(row["anchor"], []).append(row)
            for anchor, mine in by_anchor.items():
                q = np.array(mine[0]["q"], buckets[0].q.dtype)
                found += answers(buckets, q, anchor, mine[0]["label"], same, [(r["ask"], r["least"], r["most"]) for r in mine], top)
        return pa.table([pa.array(c, pa.int64()) for c in np.concatenate(found, 1)], _ANSWER)

    left = chunks.join(blocks, "dim").groupBy(*cell)
    right = asked.join(numbers.withColumnRenamed("dim", "_dim"), F.col("dim") == F.col("_dim")).drop("_dim").groupBy(*cell)
    return left.cogroup(right).applyInArrow(answer, "ask long, key long, vec_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def mine(vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows of ``vectors(vec_id, embedding, label)`` whose vec_id is divisible by ``every``. Scores,
    order, positives and the range of negatives are those :func:`oracle_sql` states. Rows without an
    id, label or vector, with an empty one, or with a null, non-finite or (64 bits of a score) larger component
    than 2^20 take no part; a zero vector does, with scores of 0. Every row counts by itself: a
    repeated row is another row, and a repeated anchor gives its rows again. Vectors of different lengths
    are not compared. Other columns are ignored; an empty table gives an empty result.
    """
    spread = F.aggregate("q", F.lit(0).cast("double"), lambda total, x: total + x.cast("double") * x)
    rows = staged(bounded_rows(vectors).withColumn("square", spread), "negative-rows")
    in_order = numbered(rows, ["dim", "square", "key"], "at")
    chunks = staged(in_order.withColumn("chunk", F.floor(F.col("at") / CHUNK)).select("dim", "chunk", "key", "vec_id", "label", "q"), "negative-chunks")
    count = rows.count()
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = anchors.count() // BLOCK + 1
    anchors = staged(
        anchors.select("dim", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "q"),
        "negative-anchors",
    )
    any_ = F.lit(-(1 << 62))
    first = anchors.select("dim", "block", F.col("anchor").alias("ask"), "anchor", "label", "q", any_.alias("least"), F.lit(1 << 62).alias("most"))
    share = min(1 << 20, int((1 << 20) * SEED_ROWS / max(1, count)) + 1)
    sample = chunks.where(F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 20)) < share).withColumn("chunk", F.lit(0))
    seeds = _ranked(ask_all(sample, first, True, positives), positives).where(F.col("rank") == positives).select("ask", F.col("score").alias("seed"))
    bounded = first.join(seeds, "ask", "left").withColumn("least", F.coalesce("seed", "least")).drop("seed")
    found = _ranked(ask_all(chunks, bounded, True, positives), positives)
    pairs = found.select(
        F.col("ask").alias("anchor"), (F.col("ask") * positives + F.col("rank") - 1).alias("ask"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    pairs = staged(pairs.join(anchors, "anchor"), "negative-pairs")
    # The smallest and the largest whole number in the range; a negative score leaves none between.
    least, most = F.expr("(positive_score + 1) div 2"), F.expr("(95 * positive_score) div 100")
    second = pairs.where("positive_score >= 0").withColumn("least", least).withColumn("most", most).where("least <= most")
    second = second.select("dim", "block", "ask", "anchor", "label", "q", "least", "most")
    chosen = _ranked(ask_all(chunks, second, False, negatives), negatives)
    named = chosen.select("ask", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(pairs, "ask").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql(every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES) -> str:
    return f"""
WITH r AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.k AS a, a.vec_id AS anchor_id, b.k AS b, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM r AS a JOIN r AS b ON a.k <> b.k AND len(a.q) = len(b.q) WHERE a.vec_id % {every} = 0),
p AS (SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= {positives})
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, vec_id, s.b)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= {negatives}
"""

"""Ranked lexical search: posting lists cut into blocks of similar documents.

Documents become sparse vectors over the terms that a block of items asks for. Tasks take them in
shards. In a shard, the posting list of every term is clustered by document similarity: some of its
documents are drawn as representatives, every document goes to the most similar one (cosine of
random projections of the vectors), and each cluster is a block. A block's summary is the
coordinatewise maximum of its documents' term contributions, so its product with an item bounds the
score of every document in it. Terms are visited rarest first; a block is skipped only if its exact
bound lies below the item's tenth score found so far. What is not skipped is scored exactly from the
whole vectors, so results equal those of scoring every document.

No posting list is shuffled or gathered: a shard's lists live in its task, and only the best of each
shard for each item travel to the final ranking. Scores use counts of the whole corpus, taken before.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import encoded, staged

TOP = 10
# Documents that a block aims at; dimensions of the projections that tell similar documents.
BLOCK_DOCS, SKETCH = 64, 16
# Items are answered in blocks of about so many distinct terms; documents times terms of a shard.
ITEM_TERMS, CELLS = 16_384, 1 << 24
# Expected size of the sample of documents that is searched first, for lower bounds of the tenth scores.
SEED_DOCS = 4096

# A-Z become a-z; bytes of other letters, digits and all beyond ASCII stay; the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: maximal runs of digits, letters and everything beyond ASCII."""
    return text.translate(_FOLD).split()


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with at least one term; ``terms`` are places in ``vocabulary``."""
    number = {term: k for k, term in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sizes, ends, terms, counts = [], [], [0], [], []
            for row, text in enumerate(encoded(batch.column(1))):
                words = terms_of(text) if text else []
                if not words:
                    continue
                for word, count in Counter(words).items():
                    if word in number:
                        terms.append(number[word])
                        counts.append(count)
                keep.append(row)
                sizes.append(len(words))
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int32())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def clusters(sketch: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Cluster number of each row of a posting list: that of its most similar representative."""
    if len(rows) <= BLOCK_DOCS:
        return np.zeros(len(rows), np.int64)
    chosen = rng.choice(rows, math.ceil(len(rows) / BLOCK_DOCS), replace=False)
    return (sketch[rows] @ sketch[chosen].T).argmax(1)


class Shard:
    """Documents of one shard: vectors of term contributions, posting lists, and their blocks."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, width: int, docs: int, total: int):
        length = 25 + (75 * n * docs) // total
        owner = np.repeat(np.arange(len(n)), np.diff(ends))
        counts = counts.astype(np.int64)
        self.terms, self.ends, self.width = terms, ends, width
        self.part = ((1_000_000_000 * counts) // (1000 * counts + 8 * length[owner])).astype(np.int32)
        self.whole = np.zeros((len(n), width), np.int32)
        self.whole[owner, terms] = self.part
        order = np.argsort(terms, kind="stable")
        self.listed, self.starts = owner[order], np.searchsorted(terms[order], np.arange(width + 1))
        self.rng = np.random.default_rng(11)
        directions = self.rng.normal(size=(width, SKETCH)).astype(np.float32)
        self.sketch = np.zeros((len(n), SKETCH), np.float32)
        for k in range(SKETCH):
            self.sketch[:, k] = np.bincount(owner, self.part * directions[terms, k], len(n))
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents of a posting list, the block of each, and the coordinatewise maxima of the blocks."""
        rows = self.listed[self.starts[term] : self.starts[term + 1]]
        if not len(rows):
            return rows, rows, np.zeros((0, self.width), np.int32)
        _, block = np.unique(clusters(self.sketch, rows, self.rng), return_inverse=True)
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        summary = np.zeros((int(block.max()) + 1, self.width), np.int32)
        np.maximum.at(summary.reshape(-1), np.repeat(block * self.width, sizes) + self.terms[at], self.part[at])
        return rows, block, summary


def best_of(shard: Shard, items: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, using: list[list[int]], low: np.ndarray, top: int):
    """(item, row, score) of the best rows of a shard for every item; equal scores by smaller row.

    ``items`` are (terms, weights times repeats); ``order`` the terms, rarest first; ``using`` the items
    of each term; ``low`` a score below which a row cannot be among an item's best.
    """
    low = low.copy()
    seen = np.zeros((len(items), len(shard.whole)), bool)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
    for term in order:
        rows, block, summary = shard.blocks(term)
        if not len(rows):
            continue
        for item in using[term]:
            terms, weights = items[item]
            bound = summary[:, terms].astype(np.int64) @ weights
            open_ = rows[(bound >= low[item])[block]]
            open_ = open_[~seen[item, open_]]
            if not len(open_):
                continue
            seen[item, open_] = True
            score = shard.whole[open_[:, None], terms].astype(np.int64) @ weights
            good = score >= low[item]
            rows_, scores = np.concatenate((found[item][0], open_[good])), np.concatenate((found[item][1], score[good]))
            best = np.lexsort((rows_, -scores))[:top]
            found[item] = rows_[best], scores[best]
            if len(best) == top:
                low[item] = max(low[item], scores[best[-1]])
    for item, (rows, scores) in enumerate(found):
        yield np.full(len(rows), item), rows, scores


def search_vectors(vecs: DataFrame, items: list[list[tuple[int, int]]], weights: np.ndarray, docs: int, total: int, low: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score): the best of every shard of ``vecs`` for items given as (term, repeats)."""
    width = len(weights)
    limit = max(256, CELLS // max(1, width))
    asked = [(np.array([t for t, _ in i], np.int64), np.array([r * int(weights[t]) for t, r in i], np.int64)) for i in items]
    using: list[list[int]] = [[] for _ in range(width)]
    for k, (terms, _) in enumerate(asked):
        for t in terms:
            using[t].append(k)
    order = np.lexsort((np.arange(width), -weights))

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        shard = pa.Table.from_batches(held).combine_chunks().sort_by([("doc_id", "ascending")])
        lists = [shard[c].combine_chunks() for c in ("terms", "counts")]
        terms, counts = (x.flatten().to_numpy() for x in lists)
        ends = np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy()))).astype(np.int64)
        parts = list(best_of(Shard(shard["n"].to_numpy(), ends, terms, counts, width, docs, total), asked, order, using, low, top))
        item, row, score = (np.concatenate([p[k] for p in parts]) for k in range(3))
        ids = shard["doc_id"].combine_chunks().take(pa.array(row))
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, limit - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == limit:
                    yield answer(held)
                    held, rows = [], 0
        if held:
            yield answer(held)

    return vecs.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents with a score above 0 for every row of ``items(item_id, text)``.

    Scores as :func:`oracle_sql` states them, over whole texts of ``docs(doc_id, text)``. Equal scores come by
    ascending doc_id, without an id last. Every row is a document or an item of its own: repeated rows are
    each ranked. Null and empty texts have no term and are neither found nor counted; items without a
    known term give no rows. Other columns are ignored; either table may be empty. A very long text is one
    sparse vector. Items are answered in blocks of about ``ITEM_TERMS`` terms, each of which reads all documents.
    """
    keyed = staged(items.select("item_id", "text", F.monotonically_increasing_id().alias("key")), "search-items")
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = size // (6 * ITEM_TERMS) + 1
    found = [_search_block(docs, keyed.where(F.pmod(F.xxhash64("key"), F.lit(number)) == k), top) for k in range(number)]
    ranked = found[0]
    for more in found[1:]:
        ranked = ranked.unionByName(more)
    return ranked


def _search_block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    wanted = [(row.key, Counter(terms_of(row.text.encode()))) for row in items.where("text is not null").select("key", "text").collect()]
    vocabulary = sorted(set().union(*(terms for _, terms in wanted)))
    if not vocabulary:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    number = {term: k for k, term in enumerate(vocabulary)}
    asked = [[(number[t], r) for t, r in terms.items()] for _, terms in wanted]
    vecs = staged(vectors(docs, vocabulary), "search-vectors")
    count, total = vecs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(vocabulary), np.int64)
    for term, df in vecs.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * int(df) + 1))) for df in held], np.int64)
    low = np.ones(len(wanted), np.int64)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))

    def ranked(rows: DataFrame) -> DataFrame:
        return search_vectors(rows, asked, weights, count, max(1, total), low, top).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # The tenth score in any part of the corpus is a lower bound of the tenth in all of it.
    share = min(1 << 20, int((1 << 20) * SEED_DOCS / max(1, count)) + 1)
    sample = vecs.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 20)) < share).repartition(1)
    for item, score in ranked(sample).where(F.col("rank") == top).select("item", "score").collect():
        low[item] = max(1, score)
    keys = items.sparkSession.createDataFrame([(k, key) for k, (key, _) in enumerate(wanted)], "item int, key long")
    named = keys.join(items.select("key", "item_id"), "key").select("item", "item_id")
    return ranked(vecs).join(named, "item").select("item_id", "rank", "doc_id", "score")


def oracle_sql(top: int = TOP) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = rf"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY k, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
m AS (SELECT k, doc_id, 25 + (75 * len(t) * docs) // total AS m FROM d, s WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS i, item_id, {words} AS t FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT i, item_id, term, count(*) AS r FROM (SELECT i, item_id, unnest(t) AS term FROM i) GROUP BY i, item_id, term),
r AS (SELECT i, item_id, k, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY i, item_id, k, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= {top}
"""

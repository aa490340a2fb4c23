"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

The graph starts from nodes dealt at random into small cells. Then neighbours of neighbours are
joined: every node gathers those it points to and those that point to it, all of them compare with each
other where at least one side is new, and each keeps the best it has met. Rounds end when few
edges are new. A node that very many point to deals them into cells, anew in every round, so no
group outgrows a task and none is cut. For this, vectors travel as one byte a component, in searches as two.

A search keeps a beam of the best nodes seen for each query, opens the best unopened ones, scores
their neighbours (of both directions) and stops when the whole beam is open. All queries of a block
advance together, one join with the graph and one with the vectors a round. The best of the beam are
scored again by cosine in double precision on the original vectors.

Equal vectors are one node, which carries its smallest ids, so copies crowd out nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard
from .common import staged
from .embeddings import unit

TOP = 5
# Neighbours kept for each node; nodes of a cell of the start; deals of the start; nodes that compare at once.
DEGREE, CELL, DEALS, MEET = 20, 32, 2, 96
# New edges, as a share of all, at which the building ends; and its most rounds.
SETTLED, ROUNDS = 0.03, 12
# Nodes of a beam, nodes opened a round, random entries, nodes of the beam scored again; queries of a block.
BEAM, OPENED, ENTRIES, FINAL, BLOCK = 512, 96, 32, 64, 4096


def nodes_of(vectors: DataFrame, top: int = TOP) -> DataFrame:
    """Stored (node, dim, embedding, ids, code, fine, scale): distinct usable vectors, ``ids`` the ``top + 1`` smallest of each."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    able = F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").where(able)
    place = Window.partitionBy("embedding").orderBy("vec_id")
    # Repeated rows share a place of dense_rank, so that ids are distinct ones.
    few = rows.withColumn("place", F.dense_rank().over(place)).where(F.col("place") <= top + 1)
    classes = few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    kind = dict(vectors.dtypes)["embedding"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).value_lengths().to_numpy()
            codes, fine, scales = [b""] * len(dims), [b""] * len(dims), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                points = unit(batch.column(1).take(pa.array(at)))
                scales[at] = largest = np.abs(points).max(1)
                for out, steps, kind_ in ((codes, 127, np.int8), (fine, 32767, np.int16)):
                    for k, row in zip(at, np.rint(points * (steps / largest)[:, None]).astype(kind_)):
                        out[k] = row.tobytes()
            binary = [pa.array(c, pa.binary()) for c in (codes, fine)]
            columns = [batch.column(0), pa.array(dims, pa.int32()), batch.column(1), batch.column(2), *binary, pa.array(scales)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "dim", "embedding", "ids", "code", "fine", "scale"])

    numbered = staged(classes.select(F.monotonically_increasing_id().alias("node"), "embedding", "ids"), "graph-classes")
    coded = numbered.mapInArrow(encode, f"node long, dim int, embedding {kind}, ids array<long>, code binary, fine binary, scale double")
    return staged(coded, "graph-nodes")


def meet(groups: DataFrame, keep: int) -> DataFrame:
    """(a, b, s): for each member of each group its ``keep`` best other members that beat its ``low``.

    ``groups`` holds ``met``, an array of (node, code, scale, low, fresh). Pairs of which neither
    side is fresh are left out: they met before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s = [], [], []
            lists = batch.column(0)
            flat = lists.flatten()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            node, scale, low, fresh = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4))
            codes = flat.field(1)
            for begin, end in zip(ends[:-1], ends[1:]):
                # A node may be there twice: as one pointed to and one that points.
                _, first, back = np.unique(node[begin:end], return_index=True, return_inverse=True)
                if len(first) < 2:
                    continue
                at = begin + first
                new = np.bincount(back, fresh[begin:end]) > 0
                points = np.frombuffer(b"".join(codes.take(pa.array(at)).to_pylist()), np.int8).reshape(len(at), -1)
                # Sums of whole numbers that the type holds exactly are the same in any order.
                points = points.astype(np.float32 if points.shape[1] <= 1024 else np.float64)
                score = (points @ points.T).astype(np.float64) * np.outer(scale[at] / 127, scale[at] / 127)
                score[~(new[:, None] | new[None, :])] = -9
                np.fill_diagonal(score, -9)
                some = min(keep, len(at) - 1)
                best = np.argpartition(-score, some - 1, axis=1)[:, :some]
                found = np.take_along_axis(score, best, 1)
                row, column = np.nonzero(found > low[at][:, None])
                a.append(node[at[row]])
                b.append(node[at[best[row, column]]])
                s.append(found[row, column])
            columns = [np.concatenate(x) if x else np.empty(0) for x in (a, b, s)]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if len(c) else pa.array([], t) for c, t in zip(columns, kinds)], ["a", "b", "s"])

    return groups.select("met").mapInArrow(run, "a long, b long, s double")


def _gathered(members: DataFrame, *key: str) -> DataFrame:
    return members.groupBy(*key).agg(F.collect_list(F.struct("node", "code", "scale", "low", "fresh")).alias("met"))


def build(nodes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """Stored edges (a, b, s) of the graph: for each node its best neighbours met, with their likeness."""
    points = nodes.select("node", "dim", "code", "scale")
    sizes = nodes.groupBy("dim").agg(F.greatest(F.lit(1), F.floor(F.count("*") / CELL)).alias("cells"))
    dealt = points.join(sizes, "dim").withColumn("deal", F.explode(F.array(*[F.lit(k) for k in range(DEALS)])))
    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("node", "deal"), F.col("cells")))
    start = _gathered(dealt.withColumn("low", F.lit(-2.0)).withColumn("fresh", F.lit(True)), "dim", "deal", "cell")
    place = Window.partitionBy("a").orderBy(F.desc("s"), "b")

    def best(edges: DataFrame) -> DataFrame:
        ranked = edges.withColumn("place", F.dense_rank().over(place)).where(F.col("place") <= degree)
        return ranked.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))

    edges = staged(best(meet(start, degree).withColumn("fresh", F.lit(True))), "graph-edges")
    for round_ in range(ROUNDS):
        new, all_ = edges.agg(F.count_if("fresh"), F.count("*")).first()
        if new <= SETTLED * all_:
            break
        lows = edges.groupBy(F.col("a").alias("node")).agg(F.when(F.count("*") == degree, F.min("s")).otherwise(F.lit(-2.0)).alias("low"))
        known = points.join(lows, "node")
        ends = edges.select(F.col("a").alias("at"), F.col("b").alias("node"), "fresh").unionByName(edges.select(F.col("b").alias("at"), F.col("a").alias("node"), "fresh"))
        busy = ends.groupBy("at").agg(F.count("*").alias("n"), F.max("fresh").alias("any")).where("any").select("at", F.ceil(F.col("n") / MEET).alias("cells"))
        members = ends.join(busy, "at").withColumn("cell", F.pmod(F.xxhash64("node", F.lit(round_)), F.col("cells"))).join(known, "node")
        met = meet(_gathered(members, "at", "cell"), degree // 2).withColumn("fresh", F.lit(True))
        after = staged(best(met.unionByName(edges.withColumn("fresh", F.lit(False)))), "graph-edges")
        discard(edges)
        edges = after
    return edges


def _queries_of(vectors: DataFrame, every: int) -> DataFrame:
    return vectors.where(F.col("vec_id") % every == 0)


def search(nodes: DataFrame, edges: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` nearest found for every row of ``queries(query_id, embedding)``.

    A query never finds its own id, and starts at its own node if its vector is one of the graph. Equal
    queries count once. Queries are answered in blocks of about ``BLOCK``.
    """
    own = nodes.select("embedding", F.col("node").alias("own"))
    asked = staged(queries.select("query_id", "embedding").distinct().join(own, "embedding", "left").select(F.monotonically_increasing_id().alias("key"), "*"), "graph-queries")
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-both")
    number = asked.count() // BLOCK + 1
    found = [_search_block(nodes, both, asked.where(F.pmod(F.xxhash64("key"), F.lit(number)) == k), top) for k in range(number)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _search_block(nodes: DataFrame, both: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    rows = asked.orderBy("key").collect()
    by_dim: dict[int, np.ndarray] = {}
    place: dict[int, np.ndarray] = {}
    for dim in {len(r.embedding) for r in rows}:
        mine = [k for k, r in enumerate(rows) if len(r.embedding) == dim]
        by_dim[dim] = unit(pa.array([list(rows[k].embedding) for k in mine], pa.list_(pa.float64())))
        place[dim] = np.full(len(rows), -1)
        place[dim][mine] = np.arange(len(mine))
    code = nodes.select("node", "dim", "fine", "scale")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, dims = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            s = np.full(len(q), -9.0)
            for dim in np.unique(dims):
                if int(dim) not in place:
                    continue
                at = np.flatnonzero((dims == dim) & (place[int(dim)][q] >= 0))
                points = np.frombuffer(b"".join(batch.column(3).take(pa.array(at)).to_pylist()), np.int16).reshape(len(at), int(dim))
                s[at] = np.einsum("ij,ij->i", by_dim[int(dim)][place[int(dim)][q[at]]], points) * batch.column(4).to_numpy()[at] / 32767
            some = pa.array(np.flatnonzero(s > -9))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some), pa.array(s).take(some)], ["q", "node", "s"])

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(code, "node").select("q", "node", "dim", "fine", "scale").mapInArrow(score, "q int, node long, s double")

    order = Window.partitionBy("q").orderBy(F.desc("s"), "node")
    unopened = Window.partitionBy("q", "open").orderBy(F.desc("s"), "node")

    def beam(seen: DataFrame) -> DataFrame:
        """The best nodes of each query and, of those not opened yet, the place in line."""
        kept = seen.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= BEAM)
        kept = kept.groupBy("q", "node", "place").agg(F.max("s").alias("s"), F.max("open").alias("open"))
        return staged(kept.withColumn("line", F.row_number().over(unopened)), "graph-beam")

    entries = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node", F.lit(3)), "node").limit(ENTRIES).collect()]
    numbers = nodes.sparkSession.createDataFrame([(k, r.own, r.query_id) for k, r in enumerate(rows)], "q int, own long, query_id long")
    doors = F.array(*[F.lit(node) for node in entries], "own")
    first = numbers.select("q", F.explode(F.array_distinct(doors)).alias("node")).where("node is not null")
    current = beam(scored(first).withColumn("open", F.lit(False)))
    while current.where("not open").take(1):
        due = ~F.col("open") & (F.col("line") <= OPENED)
        next_ = current.where(due).join(both, F.col("node") == F.col("a")).select("q", F.col("b").alias("node")).distinct()
        next_ = next_.join(current.select("q", "node"), ["q", "node"], "left_anti")
        after = beam(scored(next_).withColumn("open", F.lit(False)).unionByName(current.select("q", "node", "s", (F.col("open") | due).alias("open"))))
        discard(current)
        current = after

    kind = dict(nodes.dtypes)["embedding"]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, vectors = batch.column(0).to_numpy(), batch.column(2)
            dims, s = vectors.value_lengths().to_numpy(), np.zeros(batch.num_rows)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                s[at] = np.einsum("ij,ij->i", by_dim[int(dim)][place[int(dim)][q[at]]], unit(vectors.take(pa.array(at))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.clip(s, -1, 1))], ["q", "ids", "score"])

    last = current.where(F.col("place") <= FINAL).join(nodes, "node").select("q", "ids", F.col("embedding").cast(kind))
    ranked = last.mapInArrow(exact, "q int, ids array<long>, score double").join(numbers, "q")
    pairs = ranked.select("q", "query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 50, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found, by cosine, for rows whose vec_id is divisible by ``every``.

    Candidates are all rows of ``vectors(vec_id, embedding)`` but those with the query's id; fewer
    candidates give fewer rows. Equal scores come by ascending vec_id. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without an id, take no part. Repeated rows (equal id
    and vector) count once; an id with several vectors asks with each. Vectors of different lengths are not
    compared. Other columns are ignored; an empty table gives an empty result. The result is
    approximate: a neighbour can be missed, a score is always exact.
    """
    nodes = nodes_of(vectors, top)
    edges = build(nodes)
    asked = _queries_of(vectors, every).join(nodes.select("embedding"), "embedding", "left_semi")
    return search(nodes, edges, asked.select(F.col("vec_id").cast("long").alias("query_id"), "embedding"), top)

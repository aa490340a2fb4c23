"""Embedding near-duplicates: a forest of random-projection trees.

Equal vectors are one class; only classes are compared, and only within a label. Every tree splits
space recursively by random directions (of a few, the one along which the sample spreads most),
at the median of the sample, and sends vectors close to the boundary to both sides (spill). Rows
that meet in a leaf are compared by cosine in double precision; pairs at or above the threshold are
verified links, so no false link is returned. Trees differ by seed; their links are united.

The trees are fitted on a bounded sample; every row is indexed. A leaf that is still too large is
compared block against block, so nothing is capped. What can be missed is a pair that every tree
parts at some split by more than the spill; the tests measure recall against brute force. Trees are
grown at every size; a larger table has more levels.

Pairs are not emitted. A task counts the links of each of its rows, leaving out pairs that already
meet in an earlier leaf (each row carries the numbers of all its leaves), and returns a spanning
forest of its links for the components: both are at most one row for each row it compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, connected_components, staged

THRESHOLD = 0.93
TREES = 4
# Width of the spill on each side of a boundary, in units of the projected distance that a pair at
# the threshold has on average.
SPILL = 0.75
# Sample bound of the fit; classes a leaf aims at; classes of one side of a comparison.
SAMPLE_ROWS, LEAF_ROWS, SIDE_ROWS = 20_000, 256, 4096
# Products computed at once, and pairs summed by themselves at once: a few tens of megabytes each.
PRODUCTS, SLICE = 1 << 21, 1 << 16


def margin(dim: int, threshold: float) -> float:
    """Half-width of the spill for unit vectors of this dimension."""
    return SPILL * float(np.sqrt(2 - 2 * threshold)) / np.sqrt(dim)


def split(points: np.ndarray, width: float, rng: np.random.Generator, tries: int = 6):
    """(direction, threshold) of the widest of a few random directions; None if all points fall in the spill."""
    directions = rng.normal(size=(tries, points.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    some = points if len(points) <= 2048 else points[rng.choice(len(points), 2048, replace=False)]
    shadow = some @ directions.T
    best = int((np.quantile(shadow, 0.85, axis=0) - np.quantile(shadow, 0.15, axis=0)).argmax())
    cut = float(np.median(shadow[:, best]))
    near = np.abs(shadow[:, best] - cut) <= width
    return None if near.mean() > 0.8 else (directions[best], cut)


def grow(points: np.ndarray, width: float, levels: int, rng: np.random.Generator) -> tuple | None:
    found = split(points, width, rng) if levels and len(points) > 8 else None
    if found is None:
        return None
    shadow = points @ found[0]
    return (*found, grow(points[shadow <= found[1] + width], width, levels - 1, rng), grow(points[shadow > found[1] - width], width, levels - 1, rng))


def route(tree: tuple | None, points: np.ndarray, width: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, indices of its points); points in the spill go to both sides."""
    stack = [(tree, 1, np.arange(len(points)))]
    while stack:
        node, number, rows = stack.pop()
        if not len(rows):
            continue
        if node is None:
            yield number, rows
            continue
        shadow = points[rows] @ node[0]
        stack.append((node[2], 2 * number, rows[shadow <= node[1] + width]))
        stack.append((node[3], 2 * number + 1, rows[shadow > node[1] - width]))


def near(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine of at least ``threshold``; rows are unit vectors in double precision."""
    product = left @ right.T
    hit = product >= threshold
    # The product may round otherwise than a sum over one pair: pairs at the threshold are summed by themselves.
    i, j = np.nonzero(np.abs(product - threshold) < 1e-9)
    for begin in range(0, len(i), SLICE):
        a, b = i[begin : begin + SLICE], j[begin : begin + SLICE]
        hit[a, b] = np.einsum("ij,ij->i", left[a], right[b]) >= threshold
    return np.nonzero(hit)


def unit(values: pa.Array) -> np.ndarray:
    """Rows of a list array (all of one length) as unit vectors in double precision."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(values), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def similar_links(classes: DataFrame, threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """Links of ``classes(class, copies, label, embedding)`` found by the forest, as rows (a, b, n).

    Rows with b are links that connect all classes that any links connect (a spanning forest of each
    task). Rows without b give n, the number of vectors, copies counted, that a task found linked to
    class a; the sum over a class counts each linked class once. ``classes`` must be stored and
    hold usable, distinct vectors. Vectors of different lengths are not compared.
    """
    sizes = classes.groupBy("label", F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    levels = 1
    while (largest or 0) * 0.6**levels > LEAF_ROWS:
        levels += 1
    forests: dict[int, list] = {}
    # Half the bound is aimed at, so that the limit does not cut.
    share = min(1 << 20, int((1 << 19) * SAMPLE_ROWS / max(1, classes.count())) + 1)
    picked = classes.where(F.pmod(F.xxhash64("class", F.lit(5)), F.lit(1 << 20)) < share).limit(SAMPLE_ROWS)
    by_dim: dict[int, list] = {}
    for row in picked.select("class", "embedding").collect():
        by_dim.setdefault(len(row.embedding), []).append((row[0], list(row.embedding)))
    for dim, found in by_dim.items():
        points = unit(pa.array([v for _, v in sorted(found)], pa.list_(pa.float64())))
        forests[dim] = [grow(points, margin(dim, threshold), levels, np.random.default_rng(k)) for k in range(trees)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(3)])
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                points = unit(part.column(3))
                own = forests.get(int(dim), [None] * trees)
                met = [(k, number, at) for k, tree in enumerate(own) for number, at in route(tree, points, margin(int(dim), threshold))]
                met.sort(key=lambda m: m[:2])
                rows = np.concatenate([at for _, _, at in met])
                # A leaf is numbered by tree and place; rows keep all their leaves in this order.
                leaf = np.concatenate([np.full(len(at), k << 48 | number, np.int64) for k, number, at in met])
                order = np.argsort(rows, kind="stable")
                ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(points))))).astype(np.int32)
                all_leaves = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf[order]))
                taken = part.take(pa.array(rows))
                columns = [pa.array(np.full(len(rows), dim, np.int32)), pa.array(leaf), taken.column(2), taken.column(0), taken.column(1), all_leaves.take(pa.array(rows)), taken.column(3)]
                yield pa.RecordBatch.from_arrays(columns, ["dim", "leaf", "label", "class", "copies", "leaves", "embedding"])

    kinds = dict(classes.dtypes)
    rows = classes.select("class", "copies", "label", "embedding")
    schema = f"dim int, leaf long, label {kinds['label']}, class long, copies long, leaves array<long>, embedding {kinds['embedding']}"
    key = ["dim", "leaf", "label"]
    dealt = staged(rows.mapInArrow(deal, schema), "embedding-leaves")
    counts = dealt.groupBy(*key).agg(F.count("*").alias("n"))
    large = counts.where(F.col("n") > 2 * SIDE_ROWS).select(*key, F.ceil(F.col("n") / SIDE_ROWS).cast("int").alias("sides"))
    sided = dealt.join(large, key, "left").withColumn("sides", F.coalesce("sides", F.lit(1)))
    sided = sided.withColumn("side", F.pmod(F.xxhash64("class", F.lit(9)), F.col("sides")).cast("int"))
    cells = sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).select(
        *key, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "class", "copies", "leaves", "embedding"
    )

    def compare(key: tuple, frame: pa.Table) -> pa.Table:
        leaf, low, high = (key[k].as_py() for k in (1, 3, 4))
        frame = frame.combine_chunks().sort_by("class")
        ids, side, copies = (frame[c].to_numpy() for c in ("class", "side", "copies"))
        points = unit(frame["embedding"].combine_chunks())
        # Which earlier leaves each row is in: a pair that shares one was counted there.
        lists = frame["leaves"].combine_chunks()
        flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        owner, (_, place, size) = owner[flat < leaf], np.unique(flat[flat < leaf], return_inverse=True, return_counts=True)
        # A leaf that only one of these rows is in is shared by no pair.
        owner, (_, place) = owner[size[place] > 1], np.unique(place[size[place] > 1], return_inverse=True)
        earlier = np.zeros((len(ids), int(place.max()) + 1 if len(place) else 1), np.float32)
        earlier[owner, place] = 1
        left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
        forest, linked = Forest(len(ids)), np.zeros(len(ids), np.int64)
        step = max(1, PRODUCTS // len(right))
        for begin in range(0, len(left), step):
            part = left[begin : begin + step]
            i, j = near(points[part], points[right], threshold)
            seen = (earlier[part] @ earlier[right].T)[i, j] > 0
            i, j = part[i[~seen]], right[j[~seen]]
            if low == high:
                i, j = i[i < j], j[i < j]
            forest.add(i, j)
            linked += np.bincount(i, copies[j], len(ids)).astype(np.int64) + np.bincount(j, copies[i], len(ids)).astype(np.int64)
        a, b = np.array(forest.links, np.int64).reshape(-1, 2).T
        some = np.flatnonzero(linked)
        return pa.table(
            {
                "a": pa.array(np.concatenate((ids[a], ids[some])), pa.int64()),
                "b": pa.concat_arrays([pa.array(ids[b], pa.int64()), pa.nulls(len(some), pa.int64())]),
                "n": pa.array(np.concatenate((np.zeros(len(a), np.int64), linked[some])), pa.int64()),
            }
        )

    return cells.groupBy(*key, "low", "high").applyInArrow(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding, label)``.

    Rows link if their labels are equal and known and their cosine is at least ``threshold``. Null,
    zero and non-finite vectors, and rows without an id, link with nothing: n_links 0 and
    component_id their own id (kept, unless the id is null). Equal vectors of a label always link, and
    each row counts the others. Other columns are ignored; an empty table gives an empty result.
    """
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    able = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding", "label", F.coalesce(able, F.lit(False)).alias("able"))
    fit = rows.where("able")
    classes = fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    # Two classes may share an id; links are between classes, so each gets a number of its own.
    numbered = staged(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    links = staged(similar_links(numbered, threshold, trees), "vector-links")
    others = links.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    parts = connected_components(links.where("b is not null"), "vector-edges").select(F.col("node").alias("class"), F.col("component").alias("root"))
    placed = staged(
        numbered.join(parts, "class", "left")
        .join(others, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0))),
        "vector-placed",
    )
    # Stored by itself: joined in the same stage, the rows of a large group could not be split.
    lows = staged(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")), "vector-lows")
    member = staged(placed.join(lows, "root").select("label", "embedding", "n_links", "component_id"), "vector-members")
    linked = fit.join(member, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

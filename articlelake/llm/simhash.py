"""SimHash near-duplicates: exact Hamming search with vantage-point trees.

Fingerprints have one bit per majority over the XXH64 hashes of a text's word shingles. Only
distinct fingerprints are compared.

Hamming distance over all 64 bits separates random fingerprints badly (at radius 4 a split leaves
96 % of the pairs). Restricted to a block of bits it is still a metric, and two fingerprints that
differ in at most r bits differ in at most r // blocks bits of at least one block. So one
vantage-point tree is grown per block of bits. A node has a vantage point and a distance; by the
triangle inequality a pair within radius q can only be parted if it straddles that distance, so
rows in the band of width q beyond it go to both sides. Every linked pair meets in a shard.

The upper levels are fitted on a bounded sample and deal rows to shards; in a shard the recursion
goes on in memory down to small leaves, whose pairs are compared over all 64 bits. A shard that is
still too large (many fingerprints closer to each other than any split can tell) is compared
block against block, in tasks of bounded size. Each task returns a spanning forest of its links,
never all pairs: the links of a group of n near copies are at most n - 1 a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Forest, connected_components, encoded, staged

WORDS, RADIUS, BLOCKS = 4, 4, 3
# Sample for the upper levels; rows a shard aims at; rows of one side of a comparison.
SAMPLE_ROWS, SHARD_ROWS, SIDE_ROWS, LEAF_ROWS = 1 << 16, 1 << 12, 1 << 13, 192
CHUNK_SHINGLES = 1 << 16

_POPCOUNT = np.bitwise_count


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64-bit SimHash; bytes.lower and bytes.split treat exactly A-Z and the six ASCII spaces."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    n = max(len(tokens) - words + 1, 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, CHUNK_SHINGLES):
        part = tokens[low : min(low + CHUNK_SHINGLES, n) + words - 1]
        joined = b" ".join(part)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        ends = ends.tolist()
        if len(part) < words:
            hashes = [digest(joined, 42)]
        else:
            hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :])]  # noqa: B905
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def simhash(array: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words) for t in encoded(array)], np.uint64).view(np.int64))

    return simhash(text.cast("binary"))


def block_masks(blocks: int = BLOCKS) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:], strict=False)]


def grow(points: np.ndarray, mask: int, radius: int, levels: int, rng: np.random.Generator) -> tuple | None:
    """Upper levels of a tree: (vantage point, distance, inside, outside), or None for a shard."""
    if levels == 0 or len(points) < 2:
        return None
    split = choose(points, mask, radius, rng)
    if split is None:
        return None
    vantage, cut, d = split
    return (
        vantage,
        cut,
        grow(points[d <= cut + radius], mask, radius, levels - 1, rng),
        grow(points[d > cut], mask, radius, levels - 1, rng),
    )


def choose(points: np.ndarray, mask: int, radius: int, rng: np.random.Generator, tries: int = 4):
    """The best of a few vantage points: distance whose two sides, band included, hold the fewest pairs."""
    best = None
    for vantage in rng.choice(points, tries):
        d = _POPCOUNT((points ^ vantage) & np.uint64(mask)).astype(np.int64)
        below = np.cumsum(np.bincount(d, minlength=66))
        cuts = np.arange(64 - radius)
        inside = below[np.minimum(cuts + radius, 65)].astype(float)
        outside = len(points) - below[cuts]
        cost = inside**2 + outside**2
        cost[(inside >= len(points)) | (outside >= len(points))] = np.inf
        cut = int(cost.argmin())
        if np.isfinite(cost[cut]) and (best is None or cost[cut] < best[0]):
            best = (cost[cut], vantage, cut, d)
    if best is None or best[0] > 0.95 * float(len(points)) ** 2:
        return None
    return best[1:]


def route(tree: tuple | None, points: np.ndarray, mask: int, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard number, indices of the points that belong to it); points near a boundary go to both sides."""
    stack = [(tree, 1, np.arange(len(points)))]
    while stack:
        node, number, rows = stack.pop()
        if not len(rows):
            continue
        if node is None:
            yield number, rows
            continue
        d = _POPCOUNT((points[rows] ^ node[0]) & np.uint64(mask))
        stack.append((node[2], 2 * number, rows[d <= node[1] + radius]))
        stack.append((node[3], 2 * number + 1, rows[d > node[1]]))


def leaves(points: np.ndarray, mask: int, radius: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """The recursion inside a shard: indices of small leaves that together hold every near pair."""
    stack = [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        split = choose(points[rows], mask, radius, rng) if len(rows) > LEAF_ROWS else None
        if split is None:
            yield rows
            continue
        _, cut, d = split
        stack.append(rows[d <= cut + radius])
        stack.append(rows[d > cut])


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius`` over all bits, in blocks of bounded size."""
    step = max(1, (1 << 20) // max(len(right), 1))
    for low in range(0, len(left), step):
        i, j = np.nonzero(_POPCOUNT(left[low : low + step, None] ^ right[None, :]) <= radius)
        yield i + low, j


def _shard_links(points: np.ndarray, side: np.ndarray, cell: tuple[int, int] | None, mask: int, radius: int, part: int) -> list[tuple[int, int]]:
    forest = Forest(len(points))
    if cell is None or cell[0] == cell[1]:
        for rows in leaves(points, mask, part, np.random.default_rng(len(points))):
            own = points[rows]
            for i, j in near_pairs(own, own, radius):
                keep = i < j
                forest.add(rows[i[keep]], rows[j[keep]])
    else:
        a, b = (np.flatnonzero(side == s) for s in cell)
        for i, j in near_pairs(points[a], points[b], radius):
            forest.add(a[i], b[j])
    return forest.links


def similar_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` values within ``radius`` bits, as a spanning forest a task.

    ``prints`` must hold distinct non-null longs and be stored (it is read three times).
    """
    rows = prints.count()
    masks, part = block_masks(blocks), radius // blocks
    levels = 0
    while rows * (0.6**levels) > SHARD_ROWS:
        levels += 1
    trees: list = [None] * blocks
    if levels:
        share = min(1.0, SAMPLE_ROWS / rows) / 2
        picked = prints.where(F.pmod(F.xxhash64("fp", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(SAMPLE_ROWS)
        sample = np.sort(np.array([r.fp for r in picked.collect()], np.int64)).view(np.uint64)
        trees = [grow(sample, m, part, levels, np.random.default_rng(k)) for k, m in enumerate(masks)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, mask in enumerate(masks):
                for number, at in route(trees[k], points, mask, part):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, number, np.int64)), pa.array(points[at].view(np.int64))],
                        ["tree", "shard", "fp"],
                    )

    dealt = staged(prints.select("fp").mapInArrow(deal, "tree int, shard long, fp long"), "simhash-shards")
    # Shards beyond SIDE_ROWS are cut into sides; each pair of sides is compared in a task of its own.
    sizes = dealt.groupBy("tree", "shard").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > 2 * SIDE_ROWS).withColumn("sides", F.ceil(F.col("n") / SIDE_ROWS).cast("int"))
    side = F.pmod(F.xxhash64("fp", F.lit(9)), F.col("sides")).cast("int")
    sided = dealt.join(large, ["tree", "shard"], "left").withColumn("side", F.coalesce(side, F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("sides"), F.lit(1)) - 1))
    cells = sided.withColumn("other", other).select(
        "tree", "shard", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "fp"
    )

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tree, _, low, high = key
        points = frame.fp.to_numpy(np.int64)
        order = np.argsort(points)
        points, sides = points[order], frame.side.to_numpy()[order]
        links = _shard_links(points.view(np.uint64), sides, (low, high), masks[tree], radius, part)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": points[a], "b": points[b]})

    return cells.groupBy("tree", "shard", "low", "high").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp (signed long), component_id for every row of ``docs(doc_id, text)``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id is the
    smallest doc_id reachable. Null, empty and blank texts have fingerprint 0, linked like any
    other. Rows may repeat and ids may clash; a null id takes part, its component being the
    smallest known id of the group, or null if there is none. Other columns are ignored.
    """
    printed = staged(docs.select("doc_id", fingerprint_column(F.col("text"), words).alias("fp")), "simhash-prints")
    prints = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    links = similar_links(prints.select("fp"), radius, blocks)
    parts = connected_components(links, "simhash-links").select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = staged(prints.join(parts, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    # Stored by itself: joined in the same stage, the rows of a large group could not be split.
    lows = staged(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-lows")
    member = staged(rooted.select("fp", "root").join(lows, "root").select("fp", "component_id"), "simhash-member")
    return printed.join(member, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

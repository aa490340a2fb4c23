import random

import numpy as np
import pytest
import xxhash

from articlelake.llm import simhash
from articlelake.llm.common import connected_components

from .helpers import documents, empty, odd


def plain(text, words=4):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(points, ids, radius=4):
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    low = {}
    for i, k in enumerate(ids):
        low[find(i)] = min(low.get(find(i), k), k)
    return [low[find(i)] for i in range(len(points))]


def test_fingerprints_equal_plain_counts():
    rng = random.Random(2)
    for text in [None, "", " \t", "one", "a b c d", "A B c\x0bd\x1ce", "É é", *(" ".join(rng.choices("abcdefg", k=n)) for n in (3, 4, 5, 50, 300))]:
        assert simhash.fingerprint(None if text is None else text.encode()) == plain(text)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(map(str, range(1000)))
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", 7)
    assert simhash.fingerprint(text.encode()) == plain(text)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, n // 4, dtype=np.uint64)
    points = np.concatenate([rng.integers(0, 2**64, n // 2, dtype=np.uint64), rng.choice(centres, n)])
    for _ in range(3):
        flip = np.uint64(1) << rng.integers(0, 64, len(points)).astype(np.uint64)
        points = np.where(rng.random(len(points)) < 0.6, points ^ flip, points)
    # One large group of near copies, far closer together than any split can tell.
    ball = np.uint64(2**63 + 12345) ^ (np.uint64(1) << rng.integers(0, 64, n // 3).astype(np.uint64))
    return np.unique(np.concatenate([points, ball]))


@pytest.mark.parametrize("blocks", [1, 3, 5])
def test_trees_find_every_link(spark, monkeypatch, blocks):
    """Shards, leaves, sides and samples small enough that all paths are taken."""
    for name, value in {"SHARD_ROWS": 64, "SIDE_ROWS": 40, "LEAF_ROWS": 8, "SAMPLE_ROWS": 300}.items():
        monkeypatch.setattr(simhash, name, value)
    points = clustered(400, blocks)
    prints = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    links = simhash.similar_links(prints, blocks=blocks).collect()
    signed = lambda x: np.int64(x).view(np.uint64)
    assert all(np.bitwise_count(signed(a) ^ signed(b)) <= 4 for a, b in links)
    parts = connected_components(spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.component for r in parts.collect()}
    want = groups(points, points.view(np.int64).tolist())
    assert [got.get(i, i) for i in points.view(np.int64).tolist()] == want


def test_boundary_rows_go_to_both_sides():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    mask = simhash.block_masks(3)[1]
    tree = simhash.grow(points, mask, 1, 5, rng)
    home = {}
    for number, at in simhash.route(tree, points, mask, 1):
        for i in at.tolist():
            home.setdefault(i, set()).add(number)
    near = [(i, int(j)) for i in range(0, 2000, 10) for j in np.flatnonzero(np.bitwise_count((points ^ points[i]) & np.uint64(mask)) <= 1)]
    assert len({n for s in home.values() for n in s}) > 8 and all(home[i] & home[j] for i, j in near)


def test_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10
    assert {by[i].component_id for i in (1, 2, 3)} == {1} and by[1].fp == 0
    assert {r.component_id for r in got if r.doc_id in (6, 7)} == {6}
    assert by[None].component_id is None
    assert got[0].fp is not None and simhash.near_duplicates(empty(spark)).count() == 0


def test_null_id_joins_its_group(spark):
    got = simhash.near_duplicates(documents(spark, [(None, "one two three"), (9, "one two three"), (4, "one two three")])).collect()
    assert {r.component_id for r in got} == {4}


def test_hexadecimal(spark):
    row = spark.range(1).select(simhash.hexadecimal(simhash.F.lit(-1)).alias("a"), simhash.hexadecimal(simhash.F.lit(255)).alias("b")).first()
    assert (row.a, row.b) == ("f" * 16, "0" * 14 + "ff")


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 200)] + [(5, 5), (7, None), (301, 300), (300, 301)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + k] == 100 for k in range(200)) and got[301] == 300
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

import numpy as np

from articlelake.llm import hard_negatives as hn

KIND = "vec_id long, embedding array<float>, label int, key string, q long, block int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 5, 7, 9) for i, v, y in rows], KIND)


def brute(rows, every=50):
    """All rows against all anchors, in Python's own whole numbers."""
    able = []
    for i, v, y in rows:
        if i is not None and y is not None and v and all(x is not None and np.isfinite(x) and abs(x) <= hn.LARGEST for x in v):
            able.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (y + 1) % 10 if i % 7 == 0 else y))
    out = []
    for k, (a, q, label) in enumerate(able):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), i, n, other) for n, (i, p, other) in enumerate(able) if n != k and len(p) == len(q)]
        scored.sort()
        for s, i, _, _ in [x for x in scored if x[3] == label][:5]:
            mine = [x for x in scored if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(mine)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_many_chunks_blocks_and_buckets(spark, monkeypatch):
    """Lengths over two orders of magnitude, clusters, ties: ranges prune, nothing is missed."""
    monkeypatch.setattr(hn, "CHUNK", 300)
    monkeypatch.setattr(hn, "BLOCK", 7)
    monkeypatch.setattr(hn, "SEED_ROWS", 150)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 10))
    points = (centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 10)) * 0.2) * np.exp(rng.uniform(-3, 2, 1500))[:, None]
    points[700:760] = points[700]
    rows = [(k, p.astype(np.float32).tolist(), int(rng.integers(0, 4))) for k, p in enumerate(points)]
    want = brute(rows)
    assert len(want) > 200 and result(hn.mine(frame(spark, rows))) == want


def test_ranges_prune_and_keep_all_that_qualify():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 16))
    points = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16)) * 0.1
    q = np.rint(points / np.linalg.norm(points, axis=1, keepdims=True) * 256)
    length = np.linalg.norm(q, axis=1)
    bucket = hn.Bucket(q, length, np.arange(3000), np.zeros(3000, int), np.arange(3000))
    kept = 0
    for anchor in q[:40]:
        size = float(np.linalg.norm(anchor))
        focus = np.argsort(-np.abs(anchor))[: hn.FOCUS]
        for share in (0.5, 0.8, 0.95):
            least = share * size * size
            near = bucket.candidates(anchor / size, focus, size, least)
            near = np.ones(3000, bool) if near is None else near
            assert not ((q @ anchor >= least) & ~near).any()
            kept += near.sum() if share == 0.95 else 0
    assert kept < 0.3 * 40 * 3000


def test_odd_rows(spark):
    v, w = [1.0, 2.0], [0.6, 1.3]
    rows = [
        (0, v, 1), (0, v, 1), (1, v, 2), (2, v, 2), (3, w, 1), (4, w, 1), (4, w, 1), (50, v, 3), (100, v, None), (150, None, 1), (200, [0.0, 0.0], 1),
        (5, [0.0, 0.0], 1), (6, [0.0, 0.0], 2), (250, [None, 1.0], 1), (300, [float("nan"), 1.0], 1), (400, [1e30, 1.0], 1), (None, v, 1), (450, [], 1),
        (500, [1.0, 2.0, 3.0], 1), (8, [-1.0, -2.0], 2), (9, [-1.0, -2.0], 3), (550, [-1.0, 0.5], 2), (14, w, 9), (21, w, 0), (600, [2.0**20, 1.0], 4),
    ]
    want = brute(rows)
    assert want and result(hn.mine(frame(spark, rows))) == want


def test_empty_table(spark):
    assert hn.mine(frame(spark, [])).count() == 0


def test_corpus(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert result(hn.mine(table)) == brute([(r.vec_id, list(r.embedding), r.label) for r in table.collect()])

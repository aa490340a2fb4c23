import numpy as np

from articlelake.llm import graph_search as gs

KIND = "vec_id long, embedding array<float>, label int, node long, query_id string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, -1, "x", 9) for i, v in rows], KIND)


def brute(rows, every, top=5):
    """{query: [(score, vec_id)]} of all candidates, best first; one query an id."""
    able = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            able.setdefault(i, a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max()))
    out = {}
    for q in able:
        if q % every == 0:
            scored = sorted((-round(float(able[q] @ able[i]), 12), i) for i in able if i != q and len(able[i]) == len(able[q]))
            out[q] = [(i, -s) for s, i in scored[:top]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    pairs = [(q, i) for q, rows in want.items() for i, _ in rows]
    return sum(i in {j for j, _ in got[q]} for q, i in pairs) / len(pairs)


def test_recall_with_production_parameters(spark):
    """Random points are the hardest; a tenth of the rows are near copies of one."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(2500, 48))
    points[:250] = points[0] + rng.normal(size=(250, 48)) * 0.05
    rows = [(k, p.astype(np.float32).tolist()) for k, p in enumerate(points)]
    want = brute(rows, 50)
    got = found(gs.nearest(frame(spark, rows)))
    scores = {(q, i): s for q, r in brute(rows, 50, 2500).items() for i, s in r}
    assert all(abs(scores[q, i] - s) < 1e-9 for q, r in got.items() for i, s in r)
    assert recall(got, want) >= 0.95


def test_graph_of_several_rounds(spark):
    """Neighbours of neighbours improve the random start until few edges are new."""
    rng = np.random.default_rng(6)
    nodes = gs.nodes_of(frame(spark, [(k, p.tolist()) for k, p in enumerate(rng.normal(size=(1500, 24)).astype(np.float32))]))
    edges = gs.build(nodes).collect()
    points = {r.node: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in nodes.collect()}
    names = sorted(points)
    cosines = np.stack([points[n] for n in names]) @ np.stack([points[n] for n in names]).T
    np.fill_diagonal(cosines, -9)
    true = {n: {names[k] for k in np.argsort(-cosines[r])[: gs.DEGREE]} for r, n in enumerate(names)}
    assert len(edges) == len(set((e.a, e.b) for e in edges)) == 1500 * gs.DEGREE
    assert sum(e.b in true[e.a] for e in edges) >= 0.9 * len(edges)


def test_busy_node_is_dealt_into_cells(spark, monkeypatch):
    monkeypatch.setattr(gs, "MEET", 8)
    rng = np.random.default_rng(7)
    rows = [(k, p.tolist()) for k, p in enumerate(rng.normal(size=(400, 16)).astype(np.float32))]
    got = found(gs.nearest(frame(spark, rows)))
    assert recall(got, brute(rows, 50)) >= 0.9


def test_odd_rows(spark):
    v = [1.0, 2.0, 0.5]
    rows = [
        (0, v), (0, v), (50, [2.0, 4.0, 1.0]), (1, v), (2, v), (3, v), (4, v), (5, v), (6, v), (7, v), (100, None), (150, [0.0] * 3),
        (200, [float("nan"), 1.0, 1.0]), (250, [None, 1.0, 1.0]), (300, []), (None, v), (350, [1.0, 0.0]), (8, [0.5, 0.5]),
        (9, [-1.0, -2.0, -0.5]), (400, [1e30, 2e30, -1e30]), (10, [1e-30, 2e-30, 0.0]), (450, [float("inf"), 0.0, 0.0]), (500, [3.0]),
    ]
    want = {q: r for q, r in brute(rows, 50).items() if r}
    assert found(gs.nearest(frame(spark, rows))) == want
    assert want[0][0] == (1, 1.0) and want[350] == [(8, want[350][0][1])] and 500 not in want


def test_empty_and_tiny_tables(spark):
    assert gs.nearest(frame(spark, [])).count() == 0
    assert gs.nearest(frame(spark, [(50, [1.0, 2.0])])).count() == 0
    assert gs.nearest(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])).count() == 0


def test_corpus(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute([(r.vec_id, list(r.embedding)) for r in table.collect()], 50)
    got = found(gs.nearest(table))
    assert set(got) == set(want) and recall(got, want) >= 0.98

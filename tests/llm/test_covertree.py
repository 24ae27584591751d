import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm.covertree import CoverTree, Search, _exact, pruning, top_k, walks, whole_vectors
from granary.llm.queries import ORACLES, QUERIES


def check(tree, node, points):
    inside = points[tree.first[node] : tree.last[node]]
    assert np.sqrt(((inside - tree.centres[node]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-9
    assert tree.largest[node] == pytest.approx(np.sqrt((inside**2).sum(axis=1)).max())
    if tree.children[node]:
        below = np.arange(tree.child[node], tree.child[node] + tree.children[node])
        assert [*tree.first[below], tree.last[node]] == [tree.first[node], *tree.last[below]]
        assert tree.leaves[node] == (tree.children[below] == 0).sum() and not tree.children[below[: tree.leaves[node]]].any()
        centres = tree.centres[below]
        gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))[~np.eye(len(centres), dtype=bool)]
        assert gaps.min(initial=np.inf) > tree.radius[node] / 2 - 1e-9
        for c in below:
            check(tree, c, points)


@pytest.mark.parametrize("n", [0, 1, 5, 700])
def test_tree(n):
    x = np.random.default_rng(n).integers(-50, 50, (n, 3))
    tree = CoverTree(np.concatenate([x, x[: n // 2]]), leaf=4)
    assert sorted(tree.order.tolist()) == list(range(n + n // 2))
    if n:
        check(tree, 0, tree.points)
        for most in (1, 10, 100):
            assert 1 <= len(tree.cut(most)) <= most


def best(x, q, ids, k):
    return {i: sorted((-int(s), j) for j, s in enumerate(x @ x[i]) if j != i)[:k] for i in ids}


def found(search):
    got = {}
    for a, b, s in zip(*(v.tolist() for v in search.results()), strict=True):
        got.setdefault(a, []).append((-s, b))
    return {a: sorted(v) for a, v in got.items()}


@pytest.mark.parametrize("kind", ["clusters", "copies", "unit", "norms"])
def test_search_is_exact_and_prunes(kind):
    g = np.random.default_rng(2)
    if kind == "clusters":
        x = g.integers(-900, 900, (12, 8))[g.integers(0, 12, 3000)] + g.integers(-20, 20, (3000, 8))
    elif kind == "copies":
        x = g.integers(-900, 900, (3000, 8))
        x[::3] = x[0]
    elif kind == "unit":
        x = g.normal(0, 1, (3000, 16))
        x = np.floor(1024 * x / np.linalg.norm(x, axis=1)[:, None]).astype(int)
    else:
        x = (g.integers(-900, 900, (3000, 4)) * (g.random(3000)[:, None] ** 6)).astype(int)
    ids = np.arange(0, 3000, 30)
    search = Search(CoverTree(x[ids], 8), ids, 5)
    for i in range(0, 3000, 1000):
        search.add(CoverTree(x[i : i + 1000], 8), np.arange(i, i + 1000))
    want = best(x, x[ids], ids.tolist(), 5)
    assert found(search) == want
    assert search.compared <= 100 * 3000
    if kind in ("clusters", "norms"):
        assert search.pruned > 0 and search.compared < 100 * 3000 / 2
    # with the kth scores known beforehand nothing else is found
    known = Search(CoverTree(x[ids], 8), ids, 5, np.array([-want[i][-1][0] for i in ids.tolist()]))
    known.add(CoverTree(x, 8), np.arange(3000))
    assert found(known) == want


def test_inner_products_of_any_size():
    for top in (1 << 10, 1 << 27, 1 << 30, 1 << 31):
        g = np.random.default_rng(top)
        a, b = (g.integers(-top, top, (3, 2)).astype(float) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
        assert _exact(a, b).tolist() == want
    with pytest.raises(OverflowError):
        _exact(np.array([[2.0**60]]), np.array([[2.0**60]]))


def test_large_components_stay(spark):
    table = spark.createDataFrame([(100, [1e16, 1.0]), (1, [0.0001, 2.0]), (2, [-1.0, 0.0]), (3, [1e305, float("nan")])], "vec_id long, embedding array<double>")
    vectors = whole_vectors(table)
    assert {r.vec_id: list(r.v) for r in vectors.collect()} == {100: [1.024e19, 1024.0], 1: [0.0, 2048.0], 2: [-1024.0, 0.0]}
    assert [tuple(r) for r in top_k(vectors.where("vec_id < 2 OR vec_id = 100"), vectors.where("vec_id = 100")).collect()] == [(100, 1, 1, 1024 * 2048)]


def test_blocks_cells_rounds_and_passes(spark):
    g = np.random.default_rng(5)
    x = (g.integers(-900, 900, (9, 6))[g.integers(0, 9, 1200)] + g.integers(-20, 20, (1200, 6))).astype(float)
    x[::4] = x[0]
    vectors = spark.createDataFrame([(i, row) for i, row in enumerate(x.tolist())], "vec_id long, v array<double>")
    parts = walks(vectors, vectors.where("vec_id % 100 = 0"), 7, block=50, most=5)
    assert len(parts) > 2
    counts = pruning(parts)
    assert 0 < counts["pruned"] < counts["pairs"] and counts["compared"] < 12 * 1200
    got = {}
    for r in top_k(vectors, vectors.where("vec_id % 100 = 0"), 7, block=50, most=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    want = best(x, x, range(0, 1200, 100), 7)
    assert {q: sorted(v) for q, v in got.items()} == {q: [(i + 1, *p) for i, p in enumerate(v)] for q, v in want.items()}


def test_op9_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    got = QUERIES["op9_dual_cover_tree"](spark, sf_dir)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(ORACLES["op9_dual_cover_tree"]).fetchall())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (200, [0.0, 0.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]), (6, []), (7, [1.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.5]), (300, [5.0]), (400, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("v", F.lit("x"))
    vectors = whole_vectors(table)
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 1, 1, 6, 7, 8, 100, 200, 300]
    m = 1024 * 1024
    for most in (1, 100):
        got = sorted(map(tuple, top_k(vectors, vectors.where("vec_id % 100 = 0"), 3, most=most).collect()))
        assert got == [(0, 1, 1, 5 * m), (0, 2, 1, 5 * m), (0, 3, 100, 5 * m), (100, 1, 0, 5 * m), (100, 2, 1, 5 * m), (100, 3, 1, 5 * m), (200, 1, 0, 0), (200, 2, 1, 0), (200, 3, 1, 0), (300, 1, 7, 5 * m)]
    assert top_k(vectors.limit(0), vectors).collect() == [] == top_k(vectors, vectors.limit(0)).collect()

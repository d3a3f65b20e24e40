"""Exact top-k search and near-duplicate vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cambio.llm import covertree, itq
from cambio.llm.covertree import Search, cover_tree, top_inner_products
from cambio.llm.itq import near_duplicate_vectors

NAN, INF = float("nan"), float("inf")
ODD_VECTORS = [
    (0, [1.0, 0.0, 0.5]),
    (1, None),
    (2, [None, 1.0, 2.0]),
    (3, [NAN, 1.0, 2.0]),
    (4, [INF, 1.0, 2.0]),
    (5, [0.0, 0.0, 0.0]),
    (6, []),
    (7, [1.0, 0.0, 0.5]),
    (8, [1.0, 0.0, 0.5]),
    (8, [1.0, 0.0, 0.5]),
    (9, [-1.0, -0.0, -0.5]),
    (10, [1.0, 0.0]),
    (None, [1.0, 0.0, 0.5]),
    (50, [0.25, 0.25, 0.25]),
]


def vectors(spark, rows, kind="double"):
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    return frame.selectExpr("*", "1 AS label", "'x' AS values", "2 AS id", "3 AS bundle", "4 AS query_key", "5 AS raw")


def usable(vector):
    return vector is not None and all(v is not None and np.isfinite(v) for v in vector)


def brute_top(rows, is_query, k=5, factor=256):
    kept = sorted({(i, tuple(int(np.floor(factor * v)) for v in x)) for i, x in rows if i is not None and usable(x)})
    out = []
    for q, x in kept:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in kept if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def clustered(rng, n, dims, groups):
    centres = rng.standard_normal((groups, dims))
    x = centres[rng.integers(0, groups, n)] + rng.standard_normal((n, dims)) * rng.choice([0.0, 0.05, 0.8], (n, 1))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@pytest.mark.parametrize("seed", range(6))
def test_cover_tree(seed):
    rng = np.random.default_rng(seed)
    x = clustered(rng, 700, int(rng.integers(1, 12)), 9)
    todo, leaves = [cover_tree(x)], []
    while todo:
        node = todo.pop()
        assert np.linalg.norm(x[node.points] - node.centre, axis=1).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            todo += node.children
        else:
            leaves.append(node.points)
    assert sorted(np.concatenate(leaves)) == list(range(len(x)))


@pytest.mark.parametrize("seed", range(6))
def test_dual_tree_search(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(256 * clustered(rng, 600, 6, 7)).astype(np.int64)
    ids = rng.permutation(600)
    search = Search(x[:90], ids[:90], np.full(90, -np.inf), x, ids, 5)
    compared = []
    plain = search.compare
    search.compare = lambda a, b: (compared.append(len(a) * len(b)), plain(a, b))
    search.run()
    for row in range(90):
        scored = sorted((-int(x[row] @ x[j]), int(ids[j])) for j in range(600) if ids[j] != ids[row])[:5]
        assert [(-int(s), int(i)) for s, i in zip(search.scores[row], search.found[row], strict=True)] == scored
    assert sum(compared) < 90 * 600  # something was pruned


@pytest.mark.parametrize("block, bundle", [(2048, 512), (40, 7)])
def test_search_equals_brute_force(spark, monkeypatch, block, bundle):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    monkeypatch.setattr(covertree, "BUNDLE_QUERIES", bundle)
    rng = np.random.default_rng(3)
    x = clustered(rng, 400, 8, 5)
    x[200:330] = x[7]  # a third of all rows alike
    rows = [(int(i), [float(v) for v in x[i]]) for i in rng.permutation(400)]
    got = top_inner_products(vectors(spark, rows, "float"), F.col("vec_id") % 10 == 0)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    single = [(i, [float(np.float32(v)) for v in vector]) for i, vector in rows]
    assert sorted(map(tuple, got.collect())) == brute_top(single, lambda q: q % 10 == 0)


def test_search_odd_vectors(spark):
    got = top_inner_products(vectors(spark, ODD_VECTORS), F.col("vec_id") % 50 == 0, k=50)
    assert sorted(map(tuple, got.collect())) == brute_top(ODD_VECTORS, lambda q: q % 50 == 0, k=50)
    assert top_inner_products(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    alone = top_inner_products(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0)
    assert alone.count() == 0
    large = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [-3e6, 2.5])]
    got = top_inner_products(vectors(spark, large), F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(large, lambda q: q == 0)


def brute_links(rows):
    """{vec_id: (n_links, component)} for rows with different ids."""
    good = [(i, np.array(x, float)) for i, x in rows if usable(x) and any(x)]
    dims = max((len(x) for _, x in good), default=1)
    ids = [i for i, _ in good]
    unit = np.array([np.pad(x, (0, dims - len(x))) / np.linalg.norm(x) for _, x in good]).reshape(-1, dims)
    near = unit @ unit.T >= 0.9 if ids else np.zeros((0, 0), bool)
    np.fill_diagonal(near, False)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(near), strict=True):
        low, high = sorted((root(ids[a]), root(ids[b])))
        parent[high] = low
    degree = dict(zip(ids, near.sum(axis=1).tolist(), strict=True))
    return {i: (degree.get(i, 0), root(i)) for i, _ in rows}


def test_rotation_is_orthogonal_and_fits():
    rng = np.random.default_rng(0)
    x = clustered(rng, 500, 16, 8)
    start = np.linalg.qr(np.random.default_rng(5).standard_normal((16, 16)))[0]
    learned = itq.learn_rotation(x, np.random.default_rng(5))
    assert np.allclose(learned @ learned.T, np.eye(16), atol=1e-8)
    loss = lambda r: ((np.where(x @ r >= 0, 1, -1) - x @ r * 4) ** 2).sum()
    assert loss(learned) < loss(start)


@pytest.mark.parametrize("cell", [512, 5])
def test_links_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr("cambio.llm.buckets.CELL_MEMBERS", cell)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 24))
    x[100:160] = x[3] + 0.08 * rng.standard_normal((60, 24))
    x[160:200] = x[5]
    x[200:230] = x[9] + 0.2 * rng.standard_normal((30, 24))
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(300)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(vectors(spark, rows)).collect()}
    wanted = brute_links(rows)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in wanted.values())
    assert 0.97 * true <= found <= true
    assert all(got[i][0] <= n for i, (n, _) in wanted.items())
    assert all(got[i] == wanted[i] for i in [*range(3), *range(160, 200)])


def test_recall_at_the_threshold(spark):
    """Isolated pairs just above the threshold, the hardest case."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal((400, 64))
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.905 * x + np.sqrt(1 - 0.905**2) * noise
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(np.concatenate([x, y]))]
    got = near_duplicate_vectors(vectors(spark, rows)).where("n_links > 0").count()
    assert got >= 0.9 * 800


def test_links_of_odd_vectors(spark):
    got = sorted(map(tuple, near_duplicate_vectors(vectors(spark, ODD_VECTORS)).collect()), key=repr)
    alike = [0, 7, 8, 8]  # their copies; 10 is 26 degrees off, its cosine below 0.9
    assert len(got) == len(ODD_VECTORS)
    for vec_id, n_links, component, kept in got:
        if vec_id in alike:
            assert (n_links, component, kept) == (3, 0, vec_id == 0)
        else:
            assert (n_links, component, kept) == (0, vec_id, True)
    assert near_duplicate_vectors(vectors(spark, [])).count() == 0
    assert near_duplicate_vectors(vectors(spark, [(1, None)])).count() == 1

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    """(n_links, component) per row position."""
    def unit(v):
        a = np.array([np.nan if x is None else x for x in (v or [])], float)
        if not len(a) or not np.isfinite(a).all() or not a.any():
            return None
        return a / np.sqrt((a / np.abs(a).max() @ (a / np.abs(a).max()))) / np.abs(a).max()

    units = [unit(v) if label is not None and i is not None else None for i, v, label in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted((str(r[0]), links[i], str(None if r[0] is None else least[root(i)])) for i, r in enumerate(rows))


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("node", "n_links", "many", "rows")})
    got = vectors.near_vectors(df).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)


def clusters(rng, n, dim, spread):
    centres = rng.normal(size=(n, dim))
    return [(c + rng.normal(size=dim) * spread).astype(np.float32).tolist() for c in centres for _ in range(rng.integers(1, 6))]


def test_matches_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 32)
    rng = np.random.default_rng(0)
    rows = [(i, v, int(rng.integers(0, 3))) for i, v in enumerate(clusters(rng, 120, 6, 0.2))]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    assert found(spark, rows) == brute(rows)


def test_copies_odd_vectors_and_ids(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(i, v, 1) for i in range(30)] + [(40, w, 1), (41, w, 2), (42, v, None), (43, None, 1), (44, [], 1)]
    rows += [(45, [0.0, 0.0, 0.0], 1), (46, [1.0, None, 3.0], 1), (47, [float("nan"), 2.0, 3.0], 1),
             (48, [float("inf"), 2.0, 3.0], 1), (49, [1.0, 2.0], 1), (None, v, 1), (50, [1e-30, 2e-30, 3e-30], 1),
             (51, [1e30, 2e30, 3e30], 1), (52, [-1.0, -2.0, -3.0], 1)]
    assert found(spark, rows) == brute(rows)


def test_border_pairs(spark):
    # cosine 0.93 to within rounding, on either side
    rows = []
    for i in range(200):
        angle = np.arccos(0.93) + (i - 100) * 1e-9
        rows += [(2 * i, [1.0, 0.0], i), (2 * i + 1, [float(np.float32(np.cos(angle))), float(np.float32(np.sin(angle)))], i)]
    assert found(spark, rows) == brute(rows)


def test_trees_cover_and_prune():
    rng = np.random.default_rng(1)
    x = np.array(clusters(rng, 80, 5, 0.05), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = vectors.CoverTree(x)
    radius = 2.0
    for k, centres in enumerate(tree.centres[:-1]):
        if k:
            radius /= 2
            apart = np.sqrt(np.maximum(2 - 2 * x[centres] @ x[centres].T, 0))
            np.fill_diagonal(apart, 9)
            assert apart.min() >= radius - 1e-6 and set(tree.centres[k - 1]) <= set(centres)
    i, j = vectors.dual_pairs(tree, tree, 0.93)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(x @ x.T >= 0.93))))


def test_empty(spark):
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_vectors_that_share_an_id_keep_their_own_links(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 0, [1.0, 0.01]), (3, 0, [0.01, 1.0]), (4, 0, [1.0, 0.02]),
            (5, 1, [1.0, 0.0]), (5, 2, [0.0, 1.0]), (6, 1, [1.0, 0.01]), (7, 2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    links = sorted((r.vec_id, r.n_links) for r in vectors.near_vectors(df).collect())
    assert links == [(1, 1), (1, 2), (2, 2), (3, 1), (4, 2), (5, 0), (5, 1), (6, 1), (7, 0)]
    assert {r.component_id for r in vectors.near_vectors(df).where("vec_id in (2, 3, 4)").collect()} == {1}

"""Cross-polytope hashing: links and components equal those of brute force."""

import numpy as np
import pytest

from panelloom.llm import embeddings


def brute(rows, cosine=0.98):
    parent, degree = {r[0]: r[0] for r in rows}, [0] * len(rows)

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    by = {}
    for i, (_, e, label) in enumerate(rows):
        if e and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            by.setdefault((label, len(e)), []).append(i)
    for at in by.values():
        x = np.array([rows[i][1] for i in at], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= cosine, 1))):
            degree[at[a]] += 1
            degree[at[b]] += 1
            p, q = root(rows[at[a]][0]), root(rows[at[b]][0])
            parent[max(p, q)] = min(p, q)
    return sorted((r[0], degree[i], root(r[0])) for i, r in enumerate(rows))


def found(df, **options):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(df, **options).collect())


def test_hadamard_is_orthogonal():
    h = embeddings.hadamard(np.eye(16))
    assert (h @ h.T == 16 * np.eye(16)).all()


@pytest.mark.parametrize("block", [1024, 3])
def test_clusters_and_odd_rows(spark, block):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(40):
        centre = rng.normal(size=10 if k % 2 else 7)
        for j in range(6):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + rng.normal(size=len(centre)) * 0.02 * (j % 3)], k % 3))
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0, 0.0], 1), (1003, [1.0, None], 1), (1004, [1.0, float("nan")], 1), (1005, [1.0, float("inf")], 1)]
    rows += [(1006, [1.0, 2.0], None), (1007, [1.0, 2.0], None), (1008, [1.0], 2), (1009, [2.0], 2), (1010, [-1.0], 2), (1011, [1e-30, 1e-30], 2), (1012, [1e30, 1e30], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rep", "2 AS copies")
    assert found(df, block=block) == brute(rows)


def test_recall_on_generated_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(150):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        r = rng.normal(size=64)
        r -= (r @ a) * a
        r /= np.linalg.norm(r)
        b = 0.9805 * a + np.sqrt(1 - 0.9805**2) * r
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, b.tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = sum(n for _, n, _ in found(df))
    assert linked >= 0.99 * sum(n for _, n, _ in brute(rows))


def test_empty(spark):
    assert found(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")) == []

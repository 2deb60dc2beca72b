"""Vector range join against all pairs: clusters, boundaries, equal vectors, odd rows, small blocks."""

import numpy as np
import pytest

from bazaar.llm import vectors


def all_pairs(rows):
    n, root = len(rows), list(range(len(rows)))
    x = [None] * n
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x[i] = np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64))
    links = [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[find(i)] = min(vec_id, least.get(find(i), vec_id))
    return [(v, links[i], least.get(find(i))) for i, (v, _) in enumerate(rows)]


def cloud(seed, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for c in centres:
        for _ in range(rng.integers(1, 25)):
            rows.append(c + rng.normal(size=dim) * rng.choice([0.02, 0.25, 0.5]))
    rows = [[float(np.float32(v)) for v in r] for r in rows]
    rows += [rows[0], rows[0], [2 * v for v in rows[1]], [0.0] * dim, None, [], [1.0, 0.0], [1.0, 0.01], [None] * dim]
    rows += [[float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1)]
    return [(int(i), r) for i, r in zip(rng.permutation(len(rows)) * 2, rows, strict=True)] + [(None, rows[0])]


@pytest.mark.parametrize("seed, block, most", [(1, 8192, 1024), (2, 16, 8), (3, 5, 32)])
def test_against_all_pairs(spark, monkeypatch, seed, block, most):
    monkeypatch.setattr(vectors, "BLOCK", block)
    if most < 1024:  # as many pivots as allowed, so that boundaries matter
        monkeypatch.setattr(vectors, "chosen", lambda drawn, n, radius: drawn[:most])
    rows = cloud(seed)
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, id int").repartition(4)
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.linked(table).collect()]
    assert sorted(got, key=str) == sorted(all_pairs(rows), key=str)
    assert vectors.kept(table).count() == sum(1 for v, _, c in got if v == c)


def test_clusters_need_few_replicas():
    rng = np.random.default_rng(4)
    noise = vectors.unit(rng.normal(size=(1000, 64)))
    tight = vectors.unit(np.repeat(rng.normal(size=(50, 64)), 20, axis=0) + rng.normal(size=(1000, 64)) * 0.05)
    rng.shuffle(tight)

    def cells(x):
        pivots = vectors.chosen(x, 10**6, 0.32)
        return 1 + vectors.replicas(x @ pivots.T, pivots, 0.32)[1].sum() / len(x)

    assert cells(tight) < 3 < cells(noise)


def test_empty_and_double(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1e-9]), (3, [1e300, 1e300])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vectors.linked(table).orderBy("vec_id").collect()] == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vectors.linked(table.limit(0)).count() == 0

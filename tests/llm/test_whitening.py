"""Whitening against exact integers and plain numpy: products, sums, components, odd rows, wide entries."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaar.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, n long, size int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, 5, 7) for i, v in rows], schema).repartition(3)


def exact(x):
    x = [[int(v) for v in r] for r in x]
    d = len(x[0])
    return [sum(r[i] for r in x) for i in range(d)], [[sum(r[i] * r[j] for r in x) for j in range(i, d)] for i in range(d)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 5), st.sampled_from([0, 1, 7, 12, 40, 62]), st.integers(0, 10**6))
def test_scatter_of_a_batch(n, size, bits, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-(1 << bits), (1 << bits) + 1, size=(n, size))
    sums, cross = whitening.scattered(x)
    assert (sums, cross) == exact(x)


@given(st.integers(-(10**45), 10**45))
def test_limbs(value):
    assert sum(v << (40 * k) for k, v in enumerate(whitening._limbs(value))) == value


def plain(rows, components=4):
    """Results by plain numpy and exact integers; rows: (id, usable vector)."""
    x = [tuple(math.floor(256 * c) for c in v) for _, v in rows]
    fit = sorted(set(x))
    n, (sums, cross) = len(fit), exact(fit)
    d = len(sums)
    v = np.array([[(n * cross[min(i, j)][abs(i - j)] - sums[i] * sums[j]) / n**2 for j in range(d)] for i in range(d)])
    e, a = np.linalg.eigh(v)
    keep = [k for k in np.argsort(-e)[:components] if e[k] > 1e-12 * e.sum()]
    out = {}
    for (vec_id, _), r in zip(rows, x, strict=True):
        deviation = sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True))
        w = (np.array(r, dtype=float) - np.array(sums) / n) @ a[:, keep] / np.sqrt(e[keep])
        out[vec_id] = [(k + 1, n, deviation, w[k], e[keep[k]] / np.trace(v)) for k in range(len(keep))]
    return out


def same(got, want, tolerance=1e-9):
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c[0]) for i, rows in want.items() for c in rows)
    sign = {}
    for r in got:
        _, n, deviation, w, explained = want[r.vec_id][r.component - 1]
        assert (r.n, int(r.deviation)) == (n, deviation) and abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-6
        if abs(w) > 1e-6:
            assert sign.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
        assert abs(abs(r.whitened) - abs(w)) < tolerance * max(1, abs(w))


@pytest.mark.parametrize("dim, rows_at_once", [(6, 65536), (3, 70), (1, 65536), (2, 64)])
def test_against_numpy(spark, monkeypatch, dim, rows_at_once):
    monkeypatch.setattr(whitening, "ROWS", rows_at_once)
    rng = np.random.default_rng(dim)
    mix = rng.normal(size=(dim, dim))
    values = (rng.normal(size=(400, dim)) @ mix * 0.3).astype(np.float32).astype(float).tolist()
    values += values[:40] + [values[0]] * 100 + [[0.0] * dim, [-0.0] * dim, [1e-9] * dim]
    rows = list(enumerate(values))
    odd = [(-1, None), (-2, []), (-3, [None] * dim), (-4, [float("nan")] * dim), (-5, [float("inf")] * dim), (-6, [0.5] * (dim + 1))]
    same(whitening.whitened(frame(spark, rows + odd)).collect(), plain(rows))


def test_float_table_and_few_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(200, 9)))]
    table = frame(spark, rows, SCHEMA.replace("double", "float"))
    same(whitening.whitened(table, components=2).collect(), plain(rows, 2))


def test_wide_entries(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (v * 10.0**12).tolist()) for i, v in enumerate(rng.normal(size=(60, 3)))]
    same(whitening.whitened(frame(spark, rows)).collect(), plain(rows), 1e-6)
    far = whitening.whitened(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])])).collect()
    assert len(far) == 3 and all(math.isfinite(r.whitened) for r in far)


def test_no_variance_and_no_rows(spark):
    assert whitening.whitened(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    assert whitening.whitened(frame(spark, [(1, None)])).count() == 0
    assert whitening.whitened(frame(spark, []).limit(0)).count() == 0
    flat = whitening.whitened(frame(spark, [(1, [0.5, 0.25]), (None, [1.5, 0.25]), (3, [2.5, 0.25])])).collect()
    assert len(flat) == 3 and {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)


def test_sliced_arrow():
    column = pa.array([[1.0], None, [2.0, 3.0], [None, 1.0], [4.0, 5.0]], pa.list_(pa.float32())).slice(1)
    at, matrix = whitening.vectors(column)[2]
    assert at.tolist() == [1, 3] and matrix.tolist() == [[2.0, 3.0], [4.0, 5.0]]

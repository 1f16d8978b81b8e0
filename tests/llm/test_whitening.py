"""Spectrum slicing against LAPACK, whitening against plain numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusq.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def symmetric(n, seed, values=None):
    random = np.random.default_rng(seed)
    q, _ = np.linalg.qr(random.standard_normal((n, n)))
    values = random.standard_normal(n) if values is None else np.asarray(values, float)
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(0, 10_000), st.floats(-2, 2))
def test_inertia_counts_eigenvalues(n, seed, shift):
    a = symmetric(n, seed)
    own = np.linalg.eigvalsh(a)
    if np.abs(own - shift).min() > 1e-9:
        assert whitening.inertia_above(a, shift) == (own > shift).sum()


def test_inertia_of_indefinite_matrices_without_diagonal():
    for n in (2, 3, 5, 8):
        a = np.ones((n, n)) - np.eye(n)
        assert whitening.inertia_above(a, 0.0) == 1
        assert whitening.inertia_above(np.zeros((n, n)), 0.0) == 0


SPECTRA = [
    [5, 4, 3, 2, 1], [1], [2, 2, 2, 1, 1, 0, 0], [1, 1 - 1e-9, 1 - 2e-9, 0.5], [1e6, 1, 1e-6, 0], [0, 0, 0], [3] * 8,
    [1, 1 - 1e-13, 0.3, 0.3], list(np.geomspace(1, 1e-8, 20)),
]


@pytest.mark.parametrize("values", SPECTRA)
def test_pairs_equal_lapack(values):
    a = symmetric(len(values), 3, values)
    k = min(6, len(values))
    got, vectors = whitening.leading_eigenpairs(a, k)
    scale = max(values) or 1
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-13 * scale * len(values))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * scale


def test_large_matrix():
    x = np.random.default_rng(0).standard_normal((300, 120)) * np.linspace(1, 3, 120)
    a = x.T @ x / 300
    got, vectors = whitening.leading_eigenpairs(a, 32)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][:32], rtol=1e-13)
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12


def brute(vectors, components=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    sums = x.sum(axis=0)
    deviation = [sum(d * d for d in row) for row in (x * n - sums)]
    centred = ((x * n - sums) / n).astype(float)
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return n, deviation, centred @ basis, values, np.trace(covariance)


def test_query_equals_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    n, deviation, projected, values, trace = brute([r.embedding for r in table])
    got = {(r.vec_id, r.component): r for r in queries.op13_spectrum_slicing(spark, sf).collect()}
    assert len(got) == 32 * len(table)
    for i, r in enumerate(table):
        for k in range(32):
            g = got[r.vec_id, k + 1]
            assert (g.n, g.deviation) == (n, deviation[i])
            assert abs(abs(g.whitened) - abs(projected[i, k]) / values[k] ** 0.5) < 1e-8
            assert abs(g.explained - values[k] / trace) < 1e-12 and g.identity_error < 1e-9
    w = np.array([[got[r.vec_id, k].whitened for k in range(1, 33)] for r in table])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(32)).max() < 1e-9


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 2.0], 0), (2, [0.5, 0.0, 1.0], 0), (2, [0.5, 0.0, 1.0], 0), (None, [-3.25, 0.0, 0.125], None), (5, None, 0), (6, [], 0),
        (7, [1.0, None, 2.0], 0), (8, [float("nan"), 0.0, 0.0], 0), (9, [1.0, float("inf"), 0.0], 0), (10, [1.0, float("-inf"), 0.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS x", "'x' AS key", "1 AS n", "2 AS whitened")
    got = whitening.whiten(df).collect()
    kept = [r for r in rows if r[0] in (1, 2, None)]
    n, deviation, projected, values, trace = brute([r[1] for r in kept])
    assert sorted(map(str, (r.vec_id for r in got))) == sorted(str(r[0]) for r in kept)
    assert sorted(int(r.deviation) for r in got) == sorted(deviation)
    for r in got:
        assert r.n == 4 and len(r.whitened) == 3 and r.whitened[2] is None and r.explained[2] == 0 and r.identity_error < 1e-9
        assert abs(r.explained[0] - values[0] / trace) < 1e-12


def test_one_row_no_rows_and_uneven_rows(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert [(r.vec_id, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, [None, None], [0, 0], 0)]
    for empty in ([], [(1, None, 0)]):
        assert whitening.whiten(spark.createDataFrame(empty, SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], SCHEMA))


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(i, [float(1 << (30 + i % 3)), 1.0], 0) for i in range(6)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    _, deviation, *_ = brute([r[1] for r in rows])
    assert got == dict(enumerate(deviation)) and max(deviation) > 1 << 63

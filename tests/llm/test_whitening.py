"""Whitening against exact sums and NumPy's eigenvectors."""

import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from streamkit.llm import whitening as W

SF = "/root/testdata/sf0.001"


def expected(rows, k=32):
    """{row: (deviation, whitened up to signs)}, shares of the trace, n."""
    x = np.array([[math.floor(64 * float(v)) + 1_000_000 for v in e] for e in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(((n * r - s) ** 2).sum()) for r in x]
    centred = ((n * x - s) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return deviation, centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum(), n


def test_query_against_numpy(spark):
    data = [(i, e) for i, e in duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
            if e and all(v is not None and math.isfinite(v) for v in e)]
    deviation, whitened, share, n = expected([e for _, e in data])
    rows = E.queries()["op13_whitening"](spark, SF).collect()
    at, got = {i: k for k, (i, _) in enumerate(data)}, np.full(whitened.shape, np.nan)
    for r in rows:
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]]) and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
        got[at[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * whitened).sum(axis=0))
    assert len(rows) == got.size and np.abs(got * signs - whitened).max() < 1e-8


def test_bad_rows_and_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, n long, `dim.x` int"
    good = [(None, [1.0, 2.0], 0, 0), (4, [0.5, -3.0], 0, 0), (4, [0.5, -3.0], 0, 0), (5, [7.0, 7.5], 0, 0), (6, [-0.01, 0.0], 0, 0)]
    bad = [(1, None, 0, 0), (2, [], 0, 0), (3, [None, 1.0], 0, 0), (7, [math.nan, 0.0], 0, 0), (8, [math.inf, 0.0], 0, 0), (9, [1.0], 0, 0)]
    rows = W.whiten(spark.createDataFrame(good + bad, schema)).collect()
    deviation, whitened, share, n = expected([g[1] for g in good])
    assert sorted((r.vec_id or 0, r.deviation) for r in rows) == sorted((g[0] or 0, d) for g, d in zip(good, deviation)) and rows[0].n == n
    assert all(len(r.whitened) == 2 and np.allclose(np.array(r["values"]) / r.trace, share) for r in rows)
    same = W.whiten(spark.createDataFrame([(1, [2.0, 2.0], 0, 0)] * 3, schema)).collect()
    assert [(r.deviation, r.whitened, r.trace) for r in same] == [(0, [], 0.0)] * 3
    assert W.whiten(spark.createDataFrame(bad[:5], schema)).count() == 0 and W.whiten(spark.createDataFrame([], schema)).count() == 0
    huge = W.whiten(spark.createDataFrame([(1, [3e38, 0.0], 0, 0), (2, [-3e38, 1.0], 0, 0)], schema)).collect()
    assert [r.deviation for r in huge] == [None, None] and all(np.isfinite(r.whitened).all() for r in huge)


def test_fewer_dimensions_than_components_and_rank(spark):
    rng = np.random.default_rng(1)
    flat = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 8)) * 0 + np.repeat(rng.integers(-9, 9, size=(200, 2)), 4, axis=1)
    rows = W.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<double>").repartition(7)).collect()
    assert all(len(r.whitened) == 2 and r.identity_error < 1e-9 for r in rows)  # two independent columns, four times each


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_factor_and_rotations(d):
    rng = np.random.default_rng(d)
    m = rng.normal(size=(d, 3 * d))
    a = m @ m.T
    factor = W.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a)
    order = np.argsort((factor != 0).sum(axis=1), kind="stable")
    assert np.allclose(np.triu(factor[order], 1), 0)  # triangular in pivot order
    values, axes = W.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-12) and np.allclose(a @ axes, axes * values)
    seen = {tuple(p) for r in W.rounds(d) for p in zip(*r)} if d > 1 else set()
    assert len(seen) == d * (d - 1) // 2

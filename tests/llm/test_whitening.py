"""Whitening by polarisation, against plain fractions."""

from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pyarrow.parquet as pq

from ledgerlens.llm import queries as q
from ledgerlens.llm import whitening as w

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, x string, component string, n string"


def plain(vectors):
    """x rows, deviations, and the covariance of the different x rows, by fractions."""
    x = [[floor(256 * float(c)) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = [[Fraction(c * n - s, n) for c, s in zip(v, sums, strict=True)] for v in fit]
    d = len(sums)
    cov = np.array([[float(sum(v[i] * v[j] for v in y) / n) for j in range(d)] for i in range(d)])
    return x, n, sums, [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x], cov


def check(got, ids, vectors, components=4):
    x, n, sums, deviations, cov = plain(vectors)
    d = len(sums)
    k = min(components, d)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == len(vectors) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    centre = np.array(x, float) - np.array(sums, float) / n
    for i, far in zip(ids, deviations, strict=True):
        assert sorted(by[i]) == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in by[i].values()} == {(n, far)}
    for c in range(1, k + 1):
        col = np.array([by[i][c].whitened for i in ids])
        assert abs(by[ids[0]][c].explained - values[c - 1] / np.trace(cov)) < 1e-9
        # Whitened values times the eigenvalue's root are the projection on an eigenvector.
        vector, *_ = np.linalg.lstsq(centre, col * np.sqrt(values[c - 1]), rcond=None)
        if len(ids) > d:
            assert abs(np.linalg.norm(vector) - 1) < 1e-6
            assert np.abs(cov @ vector - values[c - 1] * vector).max() < 1e-6 * values[0]
    assert all(r.identity_error < 1e-4 for r in got)


def test_op11_on_all_embeddings(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    check(q.op11_polarised_whitening(spark, SF).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_odd_vectors(spark):
    good = [[0.5, 1.0, -2.0], [0.25, 1.5, 3.0], [1.0, -1.0, 0.0], [1.0, -1.0, 0.0], [-7.0, 0.1, 0.004], [2.0, 2.0, 2.5]]
    bad = [None, [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [0.0, -inf, 1.0], [1.0, 2.0], []]
    rows = [(k, v, "a", "b", "c") for k, v in enumerate(good + bad)]
    got = w.report(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, list(range(len(good))), good)
    assert {r.n for r in got} == {5}
    assert w.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert w.report(spark.createDataFrame(rows[len(good) :][:5], SCHEMA)).count() == 0


def test_vectors_without_variance(spark):
    got = w.report(spark.createDataFrame([(1, [1.0, 2.0], "", "", ""), (None, [1.0, 2.0], "", "", "")], SCHEMA)).collect()
    assert len(got) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in got)
    got = w.report(spark.createDataFrame([(k, [float(k), 5.0], "", "", "") for k in range(4)], SCHEMA)).collect()
    assert {r.component: r.whitened is None for r in got} == {1: False, 2: True} and all(r.identity_error < 1e-9 for r in got)
    assert {round(r.explained, 9) for r in got} == {1.0, 0.0}


def test_sums_of_squares_are_exact(monkeypatch):
    rng = np.random.default_rng(5)
    z = rng.integers(-(1 << 61), 1 << 61, (300, 7))
    want = [sum(int(v) ** 2 for v in col) for col in z.T]
    assert list(w.square_sums(z, 0)) == want == list(w.square_sums(z.astype(object), 0))
    x = rng.integers(-1000, 1000, (50, 3))
    sums = [int(s) for s in x.sum(axis=0)]
    small = w.centred(x, 50, sums)
    monkeypatch.setattr(w, "FITS", 1)
    large = w.centred(x, 50, sums)
    assert small.dtype == np.int64 and large.dtype == object and (small == large).all()


def test_covariance_from_pair_sums():
    x = np.random.default_rng(1).integers(-500, 500, (40, 5)) + 10**9
    sums = [int(s) for s in x.sum(axis=0)]
    y = w.centred(x, 40, sums)
    totals = {k: int(((y[:, i] + y[:, j]) if i != j else y[:, i]).astype(object).__pow__(2).sum()) for k, (i, j) in enumerate(w.pairs(5))}
    assert np.allclose(w.covariance(totals, 5, 40), np.cov(x.T, bias=True), rtol=1e-9)


def test_huge_entries_do_not_crash(spark):
    rows = [(k, [1e300 * (k - 1), float(k * k)], "", "", "") for k in range(4)]
    got = w.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 8 and all(r.deviation is None for r in got)

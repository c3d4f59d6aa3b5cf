"""Whitening against numpy's eigenvectors, spectrum slicing against its eigenvalues."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.whitening import above, inertia, leading, whiten

SPECTRA = {
    "spread": [9.0, 7.5, 4.2, 3.3, 2.1, 1.0, 0.4],
    "equal": [5.0, 5.0, 5.0, 2.0, 2.0, 1.0],
    "all equal": [3.0] * 6,
    "deficient": [4.0, 1.0, 0.0, 0.0, 0.0],
    "near": [2.0, 2.0 - 1e-9, 1.0, 1.0 - 1e-6, 0.5],
    "wide": [1e9, 1.0, 1e-3, 1e-6, 1e-9],
    "one": [2.5],
    "zero": [0.0, 0.0],
}


def with_spectrum(values, seed=5):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = (q * np.array(values)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("name", SPECTRA)
def test_leading(name):
    values = SPECTRA[name]
    a = with_spectrum(values)
    got = leading(a, 4)
    top = max(values)
    known = [v for v in values if v >= 1e-12 * top and v][:4]
    assert len(got) == len(known)
    assert np.allclose([e for e, _ in got], known, rtol=0, atol=1e-12 * max(top, 1e-300))
    vectors = np.array([v for _, v in got]).reshape(len(got), len(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-9)
    for e, v in got:
        assert np.linalg.norm(a @ v - e * v) <= 1e-12 * max(top, 1e-300)


def test_counts_are_those_of_eigenvalues():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 40):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for s in rng.uniform(values[0] - 1, values[-1] + 1, 20):
            assert above(a, s) == (values > s).sum()
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 1)
    assert inertia(np.zeros((3, 3))) == (0, 0)


def by_numpy(rows, most=4, scale=256):
    """(id, component) to (n, deviation, |whitened|, explained), of vectors of one length."""
    x = np.array([np.floor(scale * np.array(v, float)) for _, v in rows]).astype(int)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    result = []
    for (key, _), row in zip(rows, x):
        for k in range(min(most, x.shape[1])):
            e, u = values[-1 - k], vectors[:, -1 - k]
            w = (row - sums / n) @ u / np.sqrt(e)
            dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
            result.append((key, k + 1, n, dev, abs(w), e / values.sum()))
    return sorted(result)


def some_rows(n=400, d=9, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, np.linspace(3, 0.2, d), (n, d)) + rng.normal(0, 5, d)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_equals_numpy(spark):
    rows = some_rows()
    rows += [(1000 + i, v) for i, v in rows[:150]]  # copies are no further vectors of the fit
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    expected = by_numpy(rows)
    assert len(got) == len(expected) == 4 * len(rows)
    for r, e in zip(sorted(got, key=lambda r: (r.vec_id, r.component)), expected):
        assert (r.vec_id, r.component, r.n, r.deviation) == e[:4]
        assert abs(r.whitened) == pytest.approx(e[4], rel=1e-9, abs=1e-10)
        assert r.explained == pytest.approx(e[5], rel=1e-10)
        assert r.identity_error < 1e-9
    # one sign for all rows, and a covariance that is the identity
    w = {}
    for r in got:
        if r.vec_id < 1000:
            w.setdefault(r.vec_id, {})[r.component] = r.whitened
    m = np.array([[v[k] for k in range(1, 5)] for v in w.values()])
    assert np.allclose(np.cov(m.T, bias=True), np.eye(4), atol=1e-9)


def test_cases(spark):
    rows = [
        (1, [0.5, 1.0]), (2, [0.25, -1.0]), (3, [3.0, 0.0]), (None, [1.0, 1.0]),
        (3, [0.1, 0.1]),  # an id again, another vector
        (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
        (8, []), (9, [1.0, 2.0, 3.0]), (10, [2.0, 2.0, 4.0]),  # another length
        (11, [5.0]),  # alone of its length
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    extra = frame.select("*", F.lit("z").alias("x"), F.lit(1).alias("n"))
    got = whiten(extra).collect()
    count = {}
    for r in got:
        count[r.vec_id] = count.get(r.vec_id, 0) + 1
    assert count == {1: 2, 2: 2, 3: 4, None: 2, 9: 1, 10: 1}
    assert {r.n for r in got if r.vec_id in (9, 10)} == {2}
    assert all(abs(r.whitened) == pytest.approx(1) for r in got if r.vec_id in (9, 10))
    assert whiten(frame.where("false")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], frame.schema)
    assert whiten(same).collect() == []


def test_large_entries(spark):
    rows = [(i, [1e12 * (i % 7) + i, -3e11 * (i % 5), float(i)]) for i in range(40)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), most=1)
    got = sorted(got.collect(), key=lambda r: r.vec_id)
    for r, e in zip(got, by_numpy(rows, most=1)):
        assert abs(r.whitened) == pytest.approx(e[4], rel=1e-6, abs=1e-9)
        assert r.deviation is None  # beyond a BIGINT
        assert r.identity_error < 1e-6

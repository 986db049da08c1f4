"""Whitening against a dense eigendecomposition, and on odd rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow.llm import whitening as W


def spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    v = (q * values) @ q.T
    return (v + v.T) / 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=12), st.integers(0, 99), st.floats(-10, 10))
def test_inertia_counts(values, seed, point):
    values = np.asarray(values, float) + 0.25
    if np.abs(values - point).min() < 1e-6:
        return
    assert W.count_above(spectrum(np.random.default_rng(seed), values), point) == (values > point).sum()


SPECTRA = {
    "spread": np.linspace(1, 50, 40), "one": [3.0], "all equal": [5.0] * 30, "rank five": [9, 8, 7, 6, 5] + [0.0] * 20,
    "a pair and a cluster": [9.0, 9.0] + [5 + 1e-9 * i for i in range(20)] + [1.0] * 9, "steep": [10.0**-i for i in range(11)], "equal at the cut": [9.0] * 10 + [4.0] * 12 + [1.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_feast_finds_the_highest(name):
    v = spectrum(np.random.default_rng(1), np.asarray(SPECTRA[name], float))
    wanted = np.linalg.eigvalsh(v)[::-1]
    wanted = wanted[wanted > 1e-12 * wanted[0]][:16]
    values, vectors = W.top_eigenpairs(v, 16)
    assert len(values) == len(wanted) and np.allclose(values, wanted, rtol=1e-9, atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * wanted[0]


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, x string").repartition(3)


def test_against_dense(spark):
    rng = np.random.default_rng(2)
    base = np.float32(rng.standard_normal((250, 20)) * np.linspace(3, 0.3, 20))
    rows = [(i, base[i % 250].tolist(), 1, "a") for i in range(300)]  # 50 repeats
    rows += [(900, None, 1, "a"), (901, [1.0] * 19 + [None], 1, "a"), (902, [float("nan")] * 20, 1, "a"), (903, [float("inf")] * 20, 1, "a"), (904, [], 1, "a"), (None, base[0].tolist(), 1, "a")]
    out = W.whiten(vectors_of(spark, rows)).toPandas()
    assert list(out.columns) == [c.split()[0] for c in W.RESULT.split(", ")]
    x = (np.floor(64 * base.astype(float)).astype(np.int64) + 1_000_000)[np.arange(300) % 250]
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    want = (x - sums / n) @ u / np.sqrt(e)
    assert len(out) == 301 * 16 and set(out.n) == {n} and out.identity_error.max() < 1e-9 and out.identity_error.nunique() == 1
    got = out.dropna(subset=["vec_id"]).pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * sign, want, atol=1e-8)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    assert (out.dropna(subset=["vec_id"]).groupby("vec_id").deviation.first().to_numpy() == deviation).all()
    assert np.allclose(out.groupby("component").explained.first(), e / np.trace(v), rtol=1e-9)
    odd = out[out.vec_id.isna()].sort_values("component").whitened.to_numpy()
    assert np.array_equal(odd, got[0])  # a null id with the first vector


def test_odd_tables(spark):
    assert W.whiten(vectors_of(spark, [])).count() == 0
    assert W.whiten(vectors_of(spark, [(1, [1.0, 2.0], 1, "a")] * 3)).count() == 0  # one distinct vector
    two = W.whiten(vectors_of(spark, [(1, [0.0, 0.0], 1, "a"), (2, [1.0, 0.0], 1, "a")])).orderBy("vec_id").collect()
    assert [(r.component, r.n, r.deviation, round(abs(r.whitened), 12), round(r.explained, 12)) for r in two] == [(1, 2, 64**2, 1.0, 1.0)] * 2
    mixed = [(i, [float(i), float(i * i % 7)], 1, "a") for i in range(9)] + [(i, [float(i)], 1, "a") for i in range(20, 25)]
    out = W.whiten(vectors_of(spark, mixed)).groupBy((F.col("vec_id") >= 20).alias("short")).agg(F.max("component").alias("k"), F.max("n").alias("n")).collect()
    assert {(r.short, r.k, r.n) for r in out} == {(False, 2, 9), (True, 1, 5)}


def test_large_components(spark):
    rows = [(i, [2.0**18 * i, 1.0 * (i % 3)], 1, "a") for i in range(5)]
    out = W.whiten(vectors_of(spark, rows)).filter("vec_id = 4 AND component = 1").first()
    n, xs = 5, [(int(64 * 2.0**18 * i), 64 * (i % 3)) for i in range(5)]
    s = [sum(c) for c in zip(*xs)]
    assert out.deviation == sum((n * c - t) ** 2 for c, t in zip(xs[4], s))
    with pytest.raises(Exception, match="does not fit a long"):
        W.whiten(vectors_of(spark, [(i, [2.0**40 * i, 0.0], 1, "a") for i in range(5)])).collect()

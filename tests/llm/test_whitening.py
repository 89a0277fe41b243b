import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm.whitening import fit_whitening, polar_factor, principal_components, whitened_components

ROWS = "vec_id bigint, embedding array<float>, label int"


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, d)) * np.linspace(3, 0.3, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return [(i, [float(x) for x in row], i % 10) for i, row in enumerate(m.astype(np.float32))]


def brute(rows, k=32):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows])
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), c @ w / np.sqrt(e), e / np.trace(c.T @ c / n)


@pytest.mark.parametrize("n, d", [(400, 40), (90, 7), (12, 3)])
def test_against_a_plain_decomposition(spark, n, d):
    rows = vectors(n, d, n)
    odd = [(900, None, 1), (901, [None] + [0.0] * (d - 1), 1), (902, [math.nan] * d, 1), (903, [math.inf] + [0.0] * (d - 1), 1), (904, [1.0] * (d + 1), 1), (905, [], 1)]
    df = spark.createDataFrame(rows + odd, ROWS).repartition(5)
    got = whitened_components(df).toPandas().sort_values(["vec_id", "component"])
    k = min(32, d)
    assert len(got) == n * k and set(got.vec_id) == set(range(n))
    size, deviation, white, share = brute(rows)
    assert (got.n == size).all()
    assert (got.deviation.to_numpy().reshape(n, k) == deviation[:, None]).all()
    assert (got.deviation_exact == got.deviation.astype(str)).all()
    mine = got.whitened.to_numpy().reshape(n, k)
    assert np.abs(mine * np.sign((mine * white).sum(axis=0)) - white).max() < 1e-7
    assert np.abs(got.explained.to_numpy()[:k] - share).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1, 0], [2], [0, 0, 0], [1] * 15 + [2] * 15, [1e12, 1, 1e-3], [1 + 1e-9 * i for i in range(40)]])
def test_components_of_awkward_spectra(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, w = principal_components(v, 32)
    k, most = min(32, len(values)), max(max(values), 1e-300)
    assert np.abs(e - np.sort(values)[::-1][:k]).max() < 1e-13 * most
    assert np.abs(v @ w - w * e).max() < 1e-13 * most * len(values)
    assert np.abs(w.T @ w - np.eye(k)).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(4)
    for a in (rng.standard_normal((20, 20)), np.diag([1e-9, 1.0, 5.0]), -np.eye(3)):
        u = polar_factor(a)
        h = u.T @ a
        assert np.abs(u.T @ u - np.eye(len(a))).max() < 1e-13
        assert np.abs(h - h.T).max() < 1e-12 * np.abs(a).max() and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-12


def test_hot_vector_flat_dimension_and_clashing_names(spark):
    rnd = random.Random(1)
    rows = [(i % 50, [0.5, rnd.random(), rnd.random()] if i % 3 else [0.5, 0.25, 0.75], 1) for i in range(300)] + [(None, [0.5, 0.1, 0.2], None)]
    df = spark.createDataFrame(rows, ROWS).select("*", *[F.lit("z").alias(c) for c in ("n", "component", "_x", "whitened", "sum", "_c0")])
    got = whitened_components(df, keep=["vec_id", "n"]).collect()
    assert len(got) == 301 * 3 and got[0][1] == "z"
    flat = [r for r in got if r["component"] == 3]
    assert all(r["whitened"] is None for r in flat) and flat[0]["identity_error"] < 1e-9
    assert sum(r["vec_id"] is None for r in got) == 3


def test_nothing_and_one_row(spark):
    assert whitened_components(spark.createDataFrame([], ROWS)).collect() == []
    assert whitened_components(spark.createDataFrame([(1, None, 1), (2, [], 1)], ROWS)).collect() == []
    one = whitened_components(spark.createDataFrame([(1, [0.5, 0.25], 1)], ROWS)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]


def test_deviation_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], 1), (2, [-1e9, 0.5], 1), (3, [1e30, 0.5], 1)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in whitened_components(df).where("component = 1").collect()}
    x = {i: [math.floor(max(-(2.0**62), min(2.0**62, 64 * c))) + 1_000_000 for c in v] for i, v in ((1, (1e9, 0.0)), (2, (-1e9, 0.5)), (3, (1e30, 0.5)))}
    s = [sum(v[j] for v in x.values()) for j in range(2)]
    for i, v in x.items():
        assert got[i].deviation_exact == str(sum((3 * a - b) ** 2 for a, b in zip(v, s))) and got[i].deviation is None


def test_sums_are_exact(spark):
    df = spark.createDataFrame([(i, [i * 10**15, -i]) for i in range(2000)], "id bigint, x array<bigint>").repartition(7)
    assert fit_whitening(df, "x", 2).sums == [10**15 * 1999000, -1999000]

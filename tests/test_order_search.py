"""Order search and exact likelihood: planted series, a sequential filter and
known answers for the level test."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators.blocks import index_series
from marketlake.operators.forecast import arma, search
from marketlake.operators.forecast.prep import ForecastConfig

PLANTED = {
    "ar3": ([0.5, -0.4, 0.35], [], 0),
    "ma3": ([], [0.5, 0.3, 0.4], 0),
    "arma22": ([1.1, -0.5], [0.5, 0.4], 0),
    "ar1_once": ([0.6], [], 1),
    "ma1_twice": ([], [0.5], 2),
    "noise": ([], [], 0),
}
CFG = ForecastConfig(block_rows=300)


def simulate(ar, ma, d, n, seed, scale=2.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, scale, n + 200)
    x = np.zeros(n + 200)
    for t in range(5, n + 200):
        x[t] = e[t] + sum(a * x[t - 1 - i] for i, a in enumerate(ar)) \
            + sum(m * e[t - 1 - j] for j, m in enumerate(ma))
    x = x[200:] + 0.3
    for _ in range(d):
        x = np.cumsum(x)
    return x


def frame(spark, series):
    day = dt.date(1990, 1, 1)
    rows = [(name, day + dt.timedelta(days=i), float(v))
            for name, x in series.items() for i, v in enumerate(x)]
    return index_series(spark.createDataFrame(rows, "ticker string, date date, s double"))


def sequential(w, ar, ma):
    """(log-likelihood, last state) by a plain Kalman filter."""
    r = max(len(ar), len(ma) + 1)
    T = np.zeros((r, r))
    T[:len(ar), 0] = ar
    T[:-1, 1:] += np.eye(r - 1)
    R = np.zeros(r)
    R[0], R[1:len(ma) + 1] = 1, ma
    Q = np.outer(R, R)
    P = np.linalg.solve(np.eye(r * r) - np.kron(T, T), Q.reshape(-1)).reshape(r, r)
    a, s0, logs = np.zeros(r), 0.0, 0.0
    for y in w:
        f, v = P[0, 0], y - a[0]
        s0, logs = s0 + v * v / f, logs + np.log(f)
        k = T @ P[:, 0] / f
        a = T @ a + k * v
        P = T @ P @ T.T + Q - f * np.outer(k, k)
    n = len(w)
    return -0.5 * (n * (np.log(2 * np.pi * s0 / n) + 1) + logs), a


@pytest.fixture(scope="module")
def found(spark):
    series = {k: simulate(*v, 3000, 7 + i) for i, (k, v) in enumerate(PLANTED.items())}
    rows = frame(spark, series | {"short": [1.0, 2.0, 4.0], "flat": [5.0] * 80, "one": [3.0]})
    return search.search_orders(rows, CFG, search.SearchConfig(criterion="bic"))


def test_planted_orders_are_recovered(found):
    got = {r.ticker: r for r in found.models.collect()}
    for name, (ar, ma, d) in PLANTED.items():
        r = got[name]
        assert (r.d, r.p, r.q) == (d, len(ar), len(ma)), name
        assert np.allclose(r.ar, ar, atol=0.08) and np.allclose(r.ma, ma, atol=0.08), name
        assert abs(r.sigma2 - 4) < 0.4
    assert [(got[t].p, got[t].q) for t in ("short", "flat", "one")] == [(0, 0)] * 3


def test_newton_steps_reach_the_maximum(found):
    """Moving any coefficient lowers the exact likelihood."""
    rows = {r.ticker: [] for r in found.models.collect()}
    for r in found.series.filter("w IS NOT NULL").orderBy("ticker", "date").collect():
        rows[r.ticker].append(r.w)
    for r in found.models.filter("p + q > 0").collect():
        top, _ = sequential(rows[r.ticker], r.ar, r.ma)
        assert abs(top - r.log_likelihood) < 1e-6
        beta = np.array(r.ar + r.ma)
        for i in range(len(beta)):
            for move in (-0.01, 0.01):
                b = beta.copy()
                b[i] += move
                assert sequential(rows[r.ticker], b[:r.p], b[r.p:])[0] < top


def test_block_chain_equals_a_sequential_filter(spark):
    rng = np.random.default_rng(5)
    series, points = {}, []
    for i in range(25):
        while True:
            p = int(rng.integers(0, 6))
            q = int(rng.integers(0, 6 - p))
            ar, ma = rng.uniform(-1, 1, p), rng.uniform(-1, 1, q)
            if arma.admissible(ar, ma):
                break
        series[f"t{i:02}"] = simulate(ar, ma, 0, int(rng.integers(40, 900)), i)
        points.append((f"t{i:02}", p, q, 0, [float(x) for x in (*ar, *ma)]))
    df = spark.createDataFrame(points, search.POINT)
    for block_rows in (35, 300):
        rows = frame(spark, series).withColumn("d", F.lit(0)).withColumnRenamed("s", "w")
        rows = rows.withColumn("_blk", F.floor(F.col("_idx") / block_rows))
        got = {r.ticker: r for r in search.likelihoods(search.series_values(rows), df).collect()}
        for t, p, q, _, beta in points:
            ll, state = sequential(series[t], beta[:p], beta[p:])
            assert abs(got[t].log_likelihood - ll) < 1e-8 * abs(ll)
            assert np.allclose(got[t].state[:len(state)], state, rtol=1e-8, atol=1e-8)


def test_level_test_known_answer(spark):
    """KPSS statistic of a short series worked out by its definition."""
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=400))
    tests = search.level_tests(frame(spark, {"w": x}), ForecastConfig(block_rows=64), 2).first()

    def kpss(v):
        n, e = len(v), v - v.mean()
        wide = int(4 * (400 / 100) ** 0.25)
        lrv = (e @ e + 2 * sum((1 - k / (wide + 1)) * (e[k:] @ e[:-k])
                               for k in range(1, wide + 1))) / n
        return (np.cumsum(e) ** 2).sum() / (n * n * lrv)

    assert abs(tests.kpss0 - kpss(x)) < 1e-9 and abs(tests.kpss1 - kpss(np.diff(x))) < 1e-9
    assert tests.d == 1


def test_forecast_of_a_known_model(spark):
    """AR(1) with one difference: closed forms of level and variance."""
    level, var = arma.forecast_path(arma.padded([0.5], 6), np.zeros(5), arma.padded([2.0], 6),
                                    0.1, 1, [10.0, 0.0], 3)
    assert np.allclose(level, [12.1, 13.2, 13.8])
    assert np.allclose(var, [1, 1 + 1.5 ** 2, 1 + 1.5 ** 2 + 1.75 ** 2])


def test_steps_for_every_series(found):
    steps = search.search_steps(found, CFG)
    per = {r.ticker: r for r in steps.groupBy("ticker").agg(
        F.count("level").alias("n"), F.min("half_width").alias("least")).collect()}
    assert len(per) == len(PLANTED) + 3
    assert all(r.n == CFG.horizon for r in per.values())
    assert per["flat"].least == 0 and per["noise"].least > 0

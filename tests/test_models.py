import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import arma, outliers, rbf, resample, stationarity


def simulate(phi, theta, n, seed, d=0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    y = np.zeros(n + 200)
    for t in range(len(y)):
        y[t] = e[t] + sum(c * y[t - i - 1] for i, c in enumerate(phi) if t > i)
        y[t] += sum(c * e[t - i - 1] for i, c in enumerate(theta) if t > i)
    y = y[200:]
    return np.cumsum(y) if d else y


def frame(spark, **series):
    parts = [pd.DataFrame({"k": k, "t": np.arange(len(v)), "value": v}) for k, v in series.items()]
    return spark.createDataFrame(pd.concat(parts)).repartition(4)


@pytest.mark.parametrize("target", [None, 200])
@pytest.mark.parametrize("d", [0, 1])
def test_lag_matrix_is_the_direct_one(spark, target, d):
    y = simulate([0.5, 0.2], [], 900, 1)
    row = arma.lag_sums(frame(spark, a=y), ["k"], ["t"], "value", 5, d, target).first()
    z = np.diff(y) if d else y
    k = 5
    direct = np.array([[sum(z[t - i] * z[t - j] for t in range(k, len(z))) for j in range(k + 1)]
                       for i in range(k + 1)])
    got = arma.lag_matrices(*[np.array([row[c]]) for c in ("s", "head", "tail")])[0]
    assert row["n"] == len(z) and np.allclose(got, direct, atol=1e-8)
    assert row["last_level"] == y[-1]


def test_ar_equals_least_squares(spark):
    y = simulate([0.5, -0.3, 0.2], [], 3000, 2)
    model = arma.fit(frame(spark, a=y), ["k"], ["t"], p=3).first()
    x = np.column_stack([y[2:-1], y[1:-2], y[:-3]])
    want, sse = np.linalg.lstsq(x, y[3:], rcond=None)[:2]
    assert np.allclose(model["phi"], want, atol=1e-10)
    assert model["sigma2"] == pytest.approx(sse[0] / (len(y) - 3 - 3))
    assert model["stationary"]


def test_arma_recovers_coefficients(spark):
    y = simulate([0.6], [0.4], 6000, 5)
    model = arma.fit(frame(spark, a=y, b=simulate([0.5, 0.2], [-0.3], 6000, 8)[:6000]), ["k"], ["t"],
                     p=1, q=1).where("k = 'a'").first()
    assert model["phi"][0] == pytest.approx(0.6, abs=0.05)
    assert model["theta"][0] == pytest.approx(0.4, abs=0.05)
    assert model["sigma2"] == pytest.approx(1.0, abs=0.06)


def test_forecast_recursion_and_interval(spark):
    y = simulate([0.6], [0.4], 4000, 6, d=1)
    df = frame(spark, a=y)
    model = arma.fit(df, ["k"], ["t"], p=1, q=1, d=1).first()
    rows = arma.arima_forecast(df, ["k"], ["t"], p=1, q=1, d=1, n=8).orderBy("h").collect()
    phi, theta, s2 = model["phi"][0], model["theta"][0], model["sigma2"]
    z, e, level = y[-1] - y[-2], model["recent_e"][0], y[-1]
    psi = [1.0]
    for h, row in enumerate(rows, 1):
        z, e = phi * z + theta * e, 0.0
        level += z
        var = s2 * sum(np.cumsum(psi) ** 2)
        assert row["h"] == h
        assert row["forecast"] == pytest.approx(level)
        assert row["upper"] - row["forecast"] == pytest.approx(arma.Z_95 * np.sqrt(var))
        psi.append(phi * psi[-1] + (theta if h == 1 else 0.0))


def test_explosive_model_has_no_interval(spark):
    df = frame(spark, a=1.1 ** np.arange(60) + np.random.default_rng(0).normal(size=60) * 1e-3)
    rows = arma.arima_forecast(df, ["k"], ["t"], p=1, q=0, d=0, n=3).collect()
    assert all(r["lower"] is None and r["forecast"] > 1.1 ** 59 for r in rows)


def test_step_matrix_is_the_direct_one(spark):
    y = simulate([0.5, 0.2], [], 300, 1)
    row = arma.moment_sums(frame(spark, a=y), ["k"], ["t"], "value", 5).first()
    for k in (1, 3, 5):
        basis = np.array([[*(y[t - i] - y[t - i - 1] for i in range(k)), y[t - k]] for t in range(k, len(y))])
        got = arma.step_matrices(np.array([row["yy"]]), np.array([row["ys"][:k]]), np.array([row["ss"][:k]]),
                                 np.array([row["head"][:k + 1]]), np.array([row["tail"][:k + 1]]))[0]
        assert np.allclose(got, basis.T @ basis)


@pytest.mark.parametrize("n", [12, 24, 33, 200])
def test_hannan_rissanen_by_direct_regressions(spark, n):
    y, p, q = simulate([0.5], [0.3], n, 7), 2, 1
    model = arma.fit(frame(spark, a=y, b=simulate([0.5], [], 900, 3)), ["k"], ["t"], p=p, q=q).where("k = 'a'").first()
    m = arma.long_ar_order(n, p, q)
    k = max(p, m + q)
    lag = lambda z, j: z[k - j:len(z) - j]
    pi = np.linalg.lstsq(np.column_stack([lag(y, j) for j in range(1, m + 1)]), lag(y, 0), rcond=None)[0]
    e = np.full(n, np.nan)
    for t in range(m, n):
        e[t] = y[t] - sum(c * y[t - 1 - j] for j, c in enumerate(pi))
    x = np.column_stack([*(lag(y, j) for j in range(1, p + 1)), *(lag(e, j) for j in range(1, q + 1))])
    want = np.linalg.lstsq(x, lag(y, 0), rcond=None)[0]
    assert np.allclose(model["phi"] + model["theta"], want, atol=1e-8)
    assert model["recent_e"][0] == pytest.approx(e[-1]) and model["reason"] is None


@pytest.mark.parametrize("level", [1e6, 1e8])
def test_high_levels_keep_their_precision(spark, level):
    y = level + np.random.default_rng(1).normal(size=2000)
    model = arma.fit(frame(spark, a=y), ["k"], ["t"], p=3).first()
    x = np.column_stack([y[2:-1] - y[1:-2], y[1:-2] - y[:-3], y[:-3]])
    c = np.linalg.lstsq(x / np.abs(x).max(axis=0), np.diff(y)[2:], rcond=None)[0] / np.abs(x).max(axis=0)
    assert np.allclose(model["phi"], [1 + c[0], c[1] - c[0], c[2] - c[1]], atol=1e-5)
    assert sum(model["phi"]) == pytest.approx(1, abs=1e-4)


def test_no_series_is_lost(spark):
    df = frame(spark, **{f"s{n}": simulate([0.4], [0.2], n, n) for n in (1, 2, 3, 5, 8, *range(12, 41))}, long=simulate([0.4], [], 100_000, 4))
    for p, q, d in ((3, 0, 0), (3, 4, 0), (5, 3, 1)):
        rows = {r["k"]: r for r in arma.fit(df, ["k"], ["t"], p=p, q=q, d=d).collect()}
        assert len(rows) == 35
        assert all(r["reason"] is not None if r["phi"] is None else r["reason"] in (None, "coefficients not unique") for r in rows.values())
        assert rows["s3"]["phi"] is None and all(rows[f"s{n}"]["phi"] is not None for n in range(24, 41))
    ahead = arma.arima_forecast(df, ["k"], ["t"], n=2).where("k in ('s3', 's40')").orderBy("k", "h").collect()
    assert [r["forecast"] is None for r in ahead] == [True, True, False, False]


@pytest.mark.parametrize("target", [None, 100])
def test_adf(spark, target):
    walk, noise = simulate([], [], 500, 3, d=1), simulate([0.2], [], 500, 10)
    df = frame(spark, walk=walk, noise=noise, small=noise[:20])
    got = {r["k"]: r for r in stationarity.stationarity(df, ["k"], ["t"], target_rows=target).collect()}
    for name, y in (("walk", walk), ("noise", noise)):
        x = np.column_stack([np.ones(len(y) - 1), y[:-1]])
        dy = np.diff(y)
        beta, sse = np.linalg.lstsq(x, dy, rcond=None)[:2]
        se = np.sqrt(sse[0] / (len(dy) - 2) * np.linalg.inv(x.T @ x)[1, 1])
        assert got[name]["stat"] == pytest.approx(beta[1] / se)
    assert got["noise"]["feature"] == stationarity.BY_P
    assert got["walk"]["feature"] == stationarity.NON_STATIONARY
    assert got["small"]["feature"] == stationarity.SMALL


def test_p_value_at_critical_values(spark):
    df = spark.createDataFrame([(-3.43035,), (-2.86154,), (-2.56677,), (-20.0,), (3.0,)], "s double")
    got = [r["p"] for r in df.select(stationarity.p_value(F.col("s")).alias("p")).collect()]
    assert got == pytest.approx([0.01, 0.05, 0.10, 0.0, 1.0], abs=2e-4)


def kernel_forecast(y, n, gamma=0.125, c=20.0, landmarks=16):
    t = np.arange(1, len(y) + 1)
    m = min(landmarks, len(y))
    cs = t[-1] - np.arange(m)
    f = np.exp(-gamma * (t[:, None] - cs[None, :]) ** 2)
    w = np.linalg.solve(f.T @ f + np.eye(m) / (2 * c), f.T @ (y - y.mean()))
    ahead = t[-1] + np.arange(1, n + 1)
    return y.mean() + np.exp(-gamma * (ahead[:, None] - cs[None, :]) ** 2) @ w


def test_rbf_equals_direct_solution(spark):
    long, short = simulate([0.8], [], 400, 11) + 5, simulate([0.8], [], 9, 12)
    got = rbf.forecast_index(frame(spark, a=long, b=short), ["k"], ["t"], n=25).toPandas()
    for k, y in (("a", long), ("b", short)):
        g = got[got["k"] == k].sort_values("h")["forecast"]
        assert np.allclose(g, kernel_forecast(y, 25), atol=1e-9)
    assert got[(got["k"] == "a") & (got["h"] == 25)]["forecast"].iloc[0] == pytest.approx(long.mean())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("large", [False, True])
def test_exact_median(spark, seed, large):
    rng = np.random.default_rng(seed)
    vals = {0: rng.normal(size=801), 1: rng.exponential(1000, 500).round(1), 2: rng.integers(-3, 3, 400) * 1.0,
            3: np.concatenate([np.zeros(301), rng.normal(size=299) * 1e-6])}[seed]
    pdf = pd.DataFrame({"k": np.where(np.arange(len(vals)) % 3 == 0, "x", "y"), "value": vals})
    counts = outliers.value_counts(spark.createDataFrame(pdf), ["k"], "value")
    got = {r["k"]: r["median"] for r in outliers.median(counts, ["k"], "value", large=large).collect()}
    want = pdf.groupby("k")["value"].median()
    assert got == pytest.approx(want.to_dict(), abs=1e-15)


@pytest.mark.parametrize("target", [None, 5, 1000])
def test_mad_outliers(spark, target):
    vals = [1.0, 2, 3, 2, 1, 2, 3, 150, 150, -90]
    df = spark.createDataFrame([("a", float(v)) for v in vals] + [("flat", 4.0)] * 5 + [("flat", 4.5)],
                               "k string, value double")
    got = {(r["k"], r["value"]): r["n"] for r in outliers.mad_outliers(df, ["k"], target_rows=target).collect()}
    assert got == {("a", 150.0): 2, ("a", -90.0): 1, ("flat", 4.5): 1}


def test_resample_fills_gaps_and_carries_mean(spark):
    df = spark.createDataFrame([("a", s, float(v)) for s, v in [(0, 1), (5, 2), (31, 4), (33, 6)]],
                               "k string, s bigint, value double").withColumn("ts", F.timestamp_seconds("s"))
    got = resample.resample(df, ["k"], 10, F.col("value")).orderBy("bucket").collect()
    assert [(r["bucket"], r["total"], r["value"]) for r in got] == [
        (0, 3.0, 3.0), (10, 0.0, 1.5), (20, 0.0, 1.0), (30, 10.0, 3.25)]
    native = resample.bucket_totals(df, ["k"], 10)
    folded = resample.fold_buckets(
        native, ["k"], F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), (acc["n"] + 1).alias("n")),
        lambda acc: F.round(acc["s"] / acc["n"], 3)).orderBy("bucket").collect()
    assert [r["value"] for r in folded] == [
        r["value"] for r in resample.running_mean(native, ["k"]).orderBy("bucket").collect()]
    assert native.agg(F.sum("total")).first()[0] == 4

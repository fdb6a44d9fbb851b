"""Statistics against direct numpy computation and closed forms."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import autoregression, boxcox, correlogram, decomposition, unit_root
from driftline.operators.ordered import Series

S = Series(("s",), "ts", chunk_seconds=3600 * 40)
N = 400


def series():
    rng = np.random.default_rng(11)
    e = rng.normal(size=N)
    ar = np.zeros(N)
    for i in range(1, N):
        ar[i] = 0.6 * ar[i - 1] + e[i]
    walk = 1000 + np.cumsum(rng.normal(size=N))
    season = 10 + np.tile([1, 3, -2, 5, 0, -7.0], N // 6 + 1)[:N] + 0.3 * rng.normal(size=N)
    return {"ar": ar, "walk": walk, "season": season, "skewed": np.exp(rng.normal(size=N)), "noise": rng.normal(size=N)}


@pytest.fixture(scope="module")
def df(spark):
    parts = [pd.DataFrame({"s": k, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(range(N), unit="h"), "v": v}) for k, v in series().items()]
    return spark.createDataFrame(pd.concat(parts)).withColumn("ts", F.col("ts").cast("timestamp_ntz")).persist()


def np_acf(x, k):
    x = x - x.mean()
    return float((x[k:] * x[:-k]).sum() / (x * x).sum())


@pytest.mark.parametrize("split", [False, True])
def test_acf(df, split):
    for lags in ([1, 2, 25], list(range(1, 41))):
        rows = correlogram.acf(df, S, "v", lags, split).collect()
        assert len(rows) == len(lags) * len(series())
        for r in rows:
            assert r["n"] == N and r["acf"] == pytest.approx(np_acf(series()[r["s"]], r["lag"]), abs=1e-9)


def test_acf_of_many_lags_over_chunks_and_a_null_key(spark):
    """300 lags over chunks far shorter than the lags; a null key is a series, a short series has few lags."""
    rng = np.random.default_rng(5)
    got = {"a": rng.normal(size=900).cumsum() + 1e6, None: rng.normal(size=700), "short": rng.normal(size=20)}
    parts = [pd.DataFrame({"s": k, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(range(len(v)), unit="h"), "v": v}) for k, v in got.items()]
    df = spark.createDataFrame(pd.concat(parts), "s string, ts timestamp_ntz, v double")
    rows = correlogram.acf(df, Series(("s",), "ts"), "v", range(1, 301), rows_per_chunk=100).collect()
    assert sorted((r["s"] or "", r["lag"]) for r in rows) == sorted((k or "", i) for k, v in got.items() for i in range(1, min(301, len(v))))
    for r in rows:
        assert r["acf"] == pytest.approx(np_acf(got[r["s"]], r["lag"]), abs=1e-9)


@pytest.mark.parametrize("first, reach, block", [(0, 30, 64), (200, 150, 50), (10, 49, 7)])
def test_lag_products_by_blocks(first, reach, block):
    v, lags = np.random.default_rng(1).normal(size=300), np.arange(reach + 1)
    want = [sum(v[t] * v[t - k] for t in range(max(first, k), 300)) for k in lags]
    assert np.allclose(correlogram.lag_products(v, first, lags, block), want, atol=1e-10)


def test_pacf_matches_yule_walker(df):
    rho = correlogram.acf(df, S, "v", range(1, 9))
    got = {(r["s"], r["lag"]): r["pacf"] for r in correlogram.pacf(rho, ["s"]).collect()}
    for name, x in series().items():
        r = np.array([1.0] + [np_acf(x, k) for k in range(1, 9)])
        for k in (1, 4, 8):
            toeplitz = r[np.abs(np.subtract.outer(range(k), range(k)))]
            assert got[(name, k)] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1], abs=1e-8)


def test_chi_square_tail():
    assert correlogram._chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert correlogram._chi2_tail(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert correlogram._chi2_tail(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-9)
    assert correlogram._chi2_tail(0.0, 4) == 1.0


def np_adf(x):
    """Direct regression: lag order by AIC on the common sample, then the full sample."""
    n, dx = len(x), np.diff(x)
    top = unit_root.max_lag_for(n)

    def fit(k, first):
        rows = range(first, n - 1)
        X = np.array([[1.0, x[t], *[dx[t - j] for j in range(1, k + 1)]] for t in rows])
        y = np.array([dx[t] for t in rows])
        beta = np.linalg.lstsq(X, y, rcond=None)[0]
        ssr = ((y - X @ beta) ** 2).sum()
        return X, y, beta, ssr

    def aic(k):
        X, y, _, ssr = fit(k, top)
        return len(y) * (math.log(2 * math.pi * ssr / len(y)) + 1) + 2 * X.shape[1]

    best = min(range(top + 1), key=aic)
    X, y, beta, ssr = fit(best, best)
    cov = ssr / (len(y) - X.shape[1]) * np.linalg.inv(X.T @ X)
    return best, len(y), beta[1] / math.sqrt(cov[1, 1])


@pytest.mark.parametrize("split", [False, True])
def test_adf(df, split):
    got = {r["s"]: r for r in unit_root.adf_test(df, S, "v", split=split, rows_per_chunk=25).collect()}
    for name, x in series().items():
        lags, nobs, stat = np_adf(x)
        assert (got[name]["used_lags"], got[name]["n_obs"]) == (lags, nobs)
        assert got[name]["adf_stat"] == pytest.approx(stat, rel=1e-6)
    assert got["walk"]["stationary"] == 0 and got["ar"]["stationary"] == 1


def test_adf_published_points():
    # five percent critical value of the asymptotic distribution
    assert unit_root.p_value(-2.86154) == pytest.approx(0.05, abs=2e-3)
    assert unit_root.p_value(3.0) == 1.0 and unit_root.p_value(-20.0) == 0.0


def test_differencing_orders(df):
    orders = unit_root.infer_d(df, S, "v")
    assert {r["s"]: r["d"] for r in orders.collect()} == {"ar": 0, "walk": 1, "season": 0, "skewed": 0, "noise": 0}
    strength = decomposition.seasonality_strength(decomposition.seasonal_decompose(df, S, "v", 6), S, "v", 6)
    got = {r["s"]: r["sd"] for r in unit_root.infer_seasonal_d(df, S, "v", orders, strength, 6).collect()}
    assert got["season"] == 1 and got["noise"] == 0


@pytest.mark.parametrize("period", [6, 7])
@pytest.mark.parametrize("split", [False, True])
def test_decomposition(df, period, split):
    got = decomposition.seasonal_decompose(df, S, "v", period, split).toPandas()
    for name, x in series().items():
        part = got[got.s == name].sort_values("ts")
        half = period // 2
        weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
        trend = np.full(N, np.nan)
        trend[half : N - half] = np.convolve(x, weights / period, "valid")
        means = np.array([np.nanmean((x - trend)[i::period]) for i in range(period)])
        seasonal = np.tile(means - means.mean(), N // period + 1)[:N]
        assert np.allclose(part.trend, trend, equal_nan=True) and np.allclose(part.seasonal, seasonal)
        assert np.allclose(part.resid, x - trend - seasonal, equal_nan=True)


def test_residual_verdicts(df):
    got = {r["s"]: r for r in decomposition.residual_diagnostics(df, S, "v", 6, "4-hour").collect()}
    assert got["noise"]["white_noise"] == 1 and got["ar"]["white_noise"] == 0
    assert got["season"]["no_period"] == 0 and got["noise"]["no_trend"] == 1


def test_box_cox(df):
    got = {r["s"]: r for r in boxcox.boxcox_lambda(df, ["s"], "v").collect()}
    assert got["ar"]["lam"] is None and got["ar"]["note"] == "non_positive"
    x = series()["skewed"]

    def loglik(lam):
        z = np.log(x) if lam == 0 else (x**lam - 1) / lam
        return (lam - 1) * np.log(x).sum() - N / 2 * math.log(z.var())

    best = max((loglik(v / 2000), v / 2000) for v in range(-1000, 1000))[1]
    assert got["skewed"]["lam"] == pytest.approx(best, abs=2e-3)


def test_box_cox_there_and_back(df):
    from driftline.functions.numeric import inv_box_cox

    moved = boxcox.boxcox_by_series(df, ["s"], "v", "b").where("s = 'skewed'")
    worst = moved.select(F.max(F.abs(inv_box_cox("b", F.col("lam")) - F.col("v")))).first()[0]
    assert worst < 1e-8


def test_period_from_acf(df):
    got = {r["s"]: (r["period"], r["source"]) for r in correlogram.infer_period(df, S, "v", "4-hour").collect()}
    assert got["season"] == (6, "acf") and got["walk"][1] == "first_candidate" or got["walk"][1] == "acf"
    assert correlogram.infer_period(df, S, "v", "4-hour", manual=12).first()["period"] == 12
    with pytest.raises(ValueError):
        correlogram.infer_period(df, S, "v", "other")


def test_autoregression_recovers_and_forecasts(df):
    grid = autoregression.order_grid_search(df, S, "v", autoregression.grid_of(2, 1), m=6, split=True, rows_per_chunk=50)
    best = {r["s"]: r for r in autoregression.best_fit(grid, ["s"]).collect()}
    assert best["ar"]["p"] >= 1 and best["ar"]["coef"][0] == pytest.approx(0.6, abs=0.12)
    assert best["season"]["sp"] == 1 and best["season"]["coef"][5] == pytest.approx(1.0, abs=0.05)
    assert autoregression.short_list(grid, ["s"]).where("s = 'ar'").count() <= 10
    fits = autoregression.best_fit(grid, ["s"])
    ahead = autoregression.one_step_forecast(df, S, "v", fits, 6).where("s = 'season'").toPandas().sort_values("ts")
    assert np.sqrt(np.nanmean((ahead.y_true - ahead.y_pred) ** 2)) < 0.6
    path = autoregression.forecast_ahead(df, S, "v", fits, 6).where("s = 'season'").orderBy("step").toPandas()
    assert np.abs(path.y_pred.to_numpy() - series()["season"][-6:]).max() < 1.5


def test_differenced_fit_forecasts_the_level(df):
    grid = autoregression.order_grid_search(df, S, "v", [(0, 0)], d=1)
    walk = grid.where("s = 'walk'").first()
    assert walk["coef"] == [1.0] and walk["const"] == pytest.approx(np.diff(series()["walk"]).mean(), abs=1e-9)


def test_candidate_orders(spark):
    hints = spark.createDataFrame([("a", 3, 0)], "s string, p int, sp int")
    assert {(r["p"], r["sp"]) for r in autoregression.candidate_orders(hints, 6).collect()} == {(p, sp) for p in (0, 1, 3) for sp in (0, 1)}

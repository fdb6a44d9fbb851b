"""Whole series and their regimes from one pass, against direct numpy computation on each scope."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators import autoregression, scopes, unit_root
from driftline.operators.lagsums import nested_ssr, solve
from driftline.operators.ordered import Series
from tests.test_statistics import np_adf

N = 360
CUTS = {"r1": (0, 150), "r2": (150, 170), "r3": (170, N)}  # the second is shorter than the lags reach
S = Series(("s",), "ts", chunk_seconds=3600 * 40)


def values():
    rng = np.random.default_rng(3)
    e = rng.normal(size=N)
    mixed = np.zeros(N)
    for t in range(1, N):
        mixed[t] = 0.5 * mixed[t - 1] + e[t] + 0.6 * e[t - 1]
    season = np.tile([0, 4, -3, 6, 1, -8.0], N // 6) * 3 + np.cumsum(rng.normal(size=N)) + 50
    walk = np.cumsum(np.cumsum(rng.normal(size=N)))
    return {"mixed": 100 + mixed, "season": season, None: walk}


@pytest.fixture(scope="module")
def frame(spark):
    names = np.concatenate([[k] * (b - a) for k, (a, b) in CUTS.items()])
    rows = [(k, datetime(2024, 1, 1) + timedelta(hours=i), float(x), names[i]) for k, v in values().items() for i, x in enumerate(v)]
    rows += [(k, datetime(2025, 1, 1), None, "r3") for k in values()]
    return spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double, regime string").repartition(5).persist()


def scope_values(x):
    return {"GLOBAL": x, **{k: x[a:b] for k, (a, b) in CUTS.items()}}


@pytest.mark.parametrize("split", [False, True])
def test_matrices_of_all_scopes(frame, split):
    lags = [0, 1, 2, 5, 9]
    rows = scopes.scope_rows(frame, S, "v", "regime")
    got = {(r["s"], r["scope"]): r for r in scopes.lag_matrices(rows, S, lags, split, rows_per_chunk=23).collect()}
    assert len(got) == 12
    for name, v in values().items():
        v = v - v.mean()
        for scope, x in scope_values(v).items():
            z = np.array([[1.0, *[x[t - k] for k in lags]] for t in range(9, len(x))])
            r = got[name, scope]
            assert r["n_used"] == len(z) and np.allclose(r["head"], x[:9])
            assert np.allclose(np.reshape(r["gram"], (6, 6)), z.T @ z, rtol=1e-9, atol=1e-6)


def test_the_whole_is_its_regimes_and_the_border_rows(frame):
    lags = [0, 1, 4]
    rows = scopes.scope_rows(frame, S, "v", "regime")
    got = {(r["s"], r["scope"]): np.array(r["gram"]) for r in scopes.lag_matrices(rows, S, lags).collect()}
    for name, v in values().items():
        v = v - v.mean()
        border = np.array([[1.0, *[v[t - k] for k in lags]] for a, _ in list(CUTS.values())[1:] for t in range(a, a + 4)])
        parts = sum(got[name, k] for k in CUTS)
        assert np.allclose(got[name, "GLOBAL"], parts + (border.T @ border).ravel(), rtol=1e-9, atol=1e-6)


def test_nested_sums_match_separate_solves():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 9))
    x[:, 4] = x[:, 2] - 3 * x[:, 1]  # explained by the ones before
    x[:, 0] = 1
    gram = x.T @ x
    want = [solve(gram, list(range(k)), 8)[1] for k in range(2, 9)]
    assert np.allclose(nested_ssr(gram, 8, 2), want, rtol=1e-8)


@pytest.mark.parametrize("split", [False, True])
def test_differencing_of_all_scopes(spark, frame, split):
    strong = spark.createDataFrame([("season", "GLOBAL"), ("season", "r1"), (None, "r3")], "s string, scope string")
    got = {(r["s"], r["scope"]): r for r in unit_root.differencing_by_scope(frame, S, "v", "regime", strong, 6, split=split).collect()}
    assert len(got) == 12
    for name, v in values().items():
        for scope, x in scope_values(v).items():
            for d in range(7):
                w = np.diff(x, d)
                if d == 6 or len(w) < 8:
                    d, test = 6, None
                    break
                lags, n_obs, stat = np_adf(w)
                test = (lags, n_obs, stat)
                if unit_root.p_value(stat) < 0.05:
                    break
            r = got[name, scope]
            assert (r["n"], r["d"]) == (len(x), d)
            if test:
                assert (r["used_lags"], r["n_obs"]) == test[:2] and r["adf_stat"] == pytest.approx(test[2], rel=1e-6)
            sd = 0
            if (name, scope) in {("season", "GLOBAL"), ("season", "r1"), (None, "r3")} and test:
                w = np.diff(x, d)
                w = w[6:] - w[:-6]
                sd = int(len(w) >= 60 and unit_root.p_value(np_adf(w)[2]) < 0.05)
            assert r["sd"] == sd
    assert got["season", "GLOBAL"]["sd"] == 1 and got[None, "GLOBAL"]["d"] >= 1


def test_null_keys_keep_their_series(frame):
    assert {r["s"] for r in unit_root.adf_test(frame, S, "v").collect()} == set(values())
    orders = unit_root.infer_d(frame, S, "v")
    assert {r["s"]: r["d"] for r in orders.collect()}[None] in (1, 2)
    strength = orders.select("s", F.lit(1).alias("strong"))
    assert {r["s"] for r in unit_root.infer_seasonal_d(frame, S, "v", orders, strength, 6).collect()} == set(values())


def two_stages(x, d, sd, m, p, q, sp, sq, h):
    """Sums of squares and coefficients of all candidates by least squares on the rows of one scope."""
    w = np.diff(x, d)
    if sd:
        w = w[m:] - w[:-m]
    X = np.array([[1.0, *[w[t - k] for k in range(1, h + 1)]] for t in range(h, len(w))])
    e = np.r_[np.full(h, np.nan), w[h:] - X @ np.linalg.lstsq(X, w[h:], rcond=None)[0]]
    ar, ma = autoregression.lag_lists(p, q, sp, sq, m)
    start = max(h + max(ma), max(ar))
    out = {}
    for a in {0, 1, p}:
        for b in {0, 1, q}:
            for c in {0, 1, sp} if m else {0}:
                for f in {0, 1, sq} if m else {0}:
                    cols = [k for k in ar if k <= a or (m and c and k == m)], [k for k in ma if k <= b or (m and f and k == m)]
                    X = np.array([[1.0, *[w[t - k] for k in cols[0]], *[e[t - k] for k in cols[1]]] for t in range(start, len(w))])
                    beta = np.linalg.lstsq(X, w[start:], rcond=None)[0]
                    out[a, b, c, f] = (len(X), float(((w[start:] - X @ beta) ** 2).mean()))
    return out


@pytest.mark.parametrize("split", [False, True])
def test_orders_with_moving_averages(spark, frame, split):
    hints = spark.createDataFrame(
        [("mixed", "GLOBAL", 2, 1, 0, 0, 0, 0), ("mixed", "r1", 1, 2, 0, 0, 0, 0), ("season", "GLOBAL", 1, 1, 1, 1, 1, 1), ("season", "r3", 3, 0, 0, 1, 1, 0),
         (None, "GLOBAL", 1, 1, 0, 0, 2, 0), ("mixed", "r2", 1, 1, 0, 0, 0, 0)],
        "s string, scope string, p int, q int, sp int, sq int, d int, sd int",
    )
    grid = autoregression.search_orders(frame, S, "v", hints, 6, "regime", split=split, rows_per_chunk=60).collect()
    seen = set()
    for r in grid:
        hint = hints.where(F.col("s").eqNullSafe(r["s"]) & (F.col("scope") == r["scope"])).first() if (r["s"], r["scope"], r["model"]) not in seen else hint
        seen.add((r["s"], r["scope"], r["model"]))
        x, m = scope_values(values()[r["s"]])[r["scope"]], r["m"]
        seasonal = (hint["sp"], hint["sq"]) if m else (0, 0)
        h = autoregression.long_order(hint["p"], hint["q"], *seasonal, m)
        want = two_stages(x, hint["d"], hint["sd"] if m else 0, m, hint["p"], hint["q"], *seasonal, h)
        n, sigma2 = want[r["p"], r["q"], r["sp"], r["sq"]]
        assert r["n_used"] == n and r["sigma2"] == pytest.approx(sigma2, rel=1e-6)
        k = len([g for g in grid if (g["s"], g["scope"], g["model"]) == (r["s"], r["scope"], r["model"])])
        assert k == len(want)
        # the same forecasts from the weights of the undifferenced values
        coef = np.array(r["coef"])
        assert len(coef) <= len(x) - n
        path = [r["const"] + coef @ x[t - len(coef) : t][::-1] for t in range(len(x) - n, len(x))]
        assert ((np.array(path) - x[-n:]) ** 2).mean() == pytest.approx(sigma2, rel=1e-5)
    assert {(s, c) for s, c, _ in seen} == {("mixed", "GLOBAL"), ("mixed", "r1"), ("season", "GLOBAL"), ("season", "r3"), (None, "GLOBAL")}
    best = min((r for r in grid if (r["s"], r["scope"], r["model"]) == ("mixed", "GLOBAL", "ARIMA")), key=lambda r: r["bic"])
    assert best["q"] == 1 and best["p"] == 1

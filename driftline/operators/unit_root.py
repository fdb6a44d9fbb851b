"""Augmented Dickey-Fuller test and the differencing orders that follow from it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.lagsums import GRAM_CHUNK_ROWS, nested_ssr, solve
from driftline.operators.ordered import Series
from driftline.operators.scopes import GLOBAL, SCOPE, difference_weights, lag_matrices, mapped, scope_rows, scope_sizes, shifted
from driftline.session import join_same, pin, settle

ALPHA = 0.05
MAX_DIFF = 5
LEAST_ROWS = 8
# Published response surfaces for the test with a constant and one variable.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def max_lag_for(n: int) -> int:
    return max(0, min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))


def _poly(coefs: Sequence[float], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefs))


def p_value(stat: float) -> float:
    if math.isnan(stat):
        return float("nan")
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    z = _poly(SMALL_P if stat <= TAU_STAR else LARGE_P, stat)
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _finish(gram: np.ndarray, head: np.ndarray, n: int, lags: int | None = None) -> dict:
    """The test on ``n`` values, from the cross products of its longest design and the first values."""
    lags = max_lag_for(n) if lags is None else lags
    size = lags + 3
    gram = gram.reshape(size, size)
    target = size - 1
    common = n - 1 - lags
    cols = np.arange(2, lags + 3)
    ssr = nested_ssr(gram, target, 2)
    aic = common * (math.log(2 * math.pi) + np.log(np.maximum(ssr, 1e-300) / common) + 1) + 2 * cols
    best = int(np.argmin(aic))
    # a shorter design is complete for some earlier rows as well
    full, steps = gram.copy(), np.diff(head, prepend=np.nan)
    for t in range(best + 1, lags + 1):
        x = np.zeros(size)
        x[0], x[1], x[target] = 1.0, head[t - 1], steps[t]
        x[2 : 2 + best] = [steps[t - k] for k in range(1, best + 1)]
        full += np.outer(x, x)
    cols = list(range(best + 2))
    nobs = n - 1 - best
    beta, ssr, inv = solve(full, cols, target)
    spread = math.sqrt(max(ssr / max(nobs - len(cols), 1) * inv[1, 1], 0.0))
    stat = float(beta[1] / spread) if spread > 0 else float("nan")
    return {
        "adf_stat": stat,
        "p_value": p_value(stat),
        "used_lags": best,
        "n_obs": nobs,
        **{name: _poly(c, 1.0 / nobs) for name, c in CRITICAL.items()},
    }


def lags_wanted(n: int, max_lag: int | None) -> int:
    return max_lag_for(n) if max_lag is None else max(0, min(max_lag, n // 2 - 2))


def tested_differences(gram: np.ndarray, head: np.ndarray, n: int, lags: Sequence[int], d: int, sd: int = 0, m: int = 0, max_lag: int | None = None) -> dict | None:
    """The test on the differences of a scope of ``n`` values, from the cross products of its values at ``lags``."""
    weights = difference_weights(d, sd, m)
    lost = len(weights) - 1
    left = n - lost
    if left < LEAST_ROWS:
        return None
    most = lags_wanted(left, max_lag)
    step = np.convolve(weights, [1.0, -1.0])
    columns = [shifted(weights, 1), *[shifted(step, k) for k in range(1, most + 1)], step]
    full = mapped(gram, lags, columns)
    # the matrix holds rows with all lags; shorter designs are complete earlier
    start = np.convolve(head, weights, "valid") if len(head) >= len(weights) else np.empty(0)
    steps = np.diff(start, prepend=np.nan)
    for t in range(most + 1, len(start)):
        x = np.r_[1.0, start[t - 1], [steps[t - k] for k in range(1, most + 1)], steps[t]]
        full += np.outer(x, x)
    return _finish(full, start, left, most)


def tested_scopes(rows: DataFrame, series: Series, m: int, max_diff: int, max_lag: int | None, split: bool | None) -> tuple[DataFrame, list[int]]:
    """Lag matrices and sizes of all scopes, wide enough for tests after any differencing, and their lags."""
    sizes = pin(scope_sizes(rows, series))
    longest = sizes.agg(F.max("n").alias("n")).first()["n"] or LEAST_ROWS
    near = lags_wanted(longest, max_lag) + 1 + max_diff
    lags = sorted({*range(near + 1), *(range(m, m + near + 1) if m else ())})
    return join_same(lag_matrices(rows, series, lags, split), sizes, [*series.keys, SCOPE]), lags


def differencing_by_scope(
    df: DataFrame,
    series: Series,
    col: str,
    regime: str | None = None,
    strong: DataFrame | None = None,
    period: int = 0,
    alpha: float = ALPHA,
    max_diff: int = MAX_DIFF,
    max_lag: int | None = None,
    split: bool | None = None,
) -> DataFrame:
    """``d`` and ``sd`` for each whole series and each of its regimes, with the test they rest on, from one pass.

    ``d`` is how often values must be differenced until the test accepts them, one more than ``max_diff`` if it never does.
    ``sd`` is 1 for scopes (keys, scope) in ``strong`` that keep max(60, 5 * period) rows and pass after a seasonal difference.
    ``regime`` names a column whose values are contiguous in time; without it only the whole series is tested. Scopes of
    fewer than 8 rows and constant ones are left out.
    """
    keys = list(series.keys)
    rows = scope_rows(df, series, col, regime)
    m = period if strong is not None and period > 1 else 0
    found, lags = tested_scopes(rows, series, m, max_diff, max_lag, split)
    found = found.where(F.col("n") >= LEAST_ROWS)
    mark = F.lit(False)
    if m:
        found = join_same(found, strong.select(*keys, SCOPE).distinct().withColumn("_strong", F.lit(True)), [*keys, SCOPE], "left")
        mark = F.coalesce("_strong", F.lit(False))
    found = found.select(*keys, SCOPE, "gram", "head", "n", mark.alias("strong"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.select(*keys).schema.fields)
    fields = f"{SCOPE} string, n bigint, d int, sd int, adf_stat double, p_value double, used_lags int, n_obs bigint"
    names = [f.split()[0] for f in fields.split(", ")]

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kept, out = [], []
            for i, (scope, gram, head, n, is_strong) in enumerate(zip(pdf[SCOPE], pdf["gram"], pdf["head"], pdf["n"], pdf["strong"])):
                gram, head, n = np.asarray(gram, float).reshape(len(lags) + 1, -1), np.asarray(head, float), int(n)
                if gram[1, 1] + head @ head <= 0:
                    continue
                test, d = None, 0
                for d in range(max_diff + 2):
                    test = tested_differences(gram, head, n, lags, d, max_lag=max_lag) if d <= max_diff else None
                    if test is None or test["p_value"] < alpha:
                        break
                if test is None:
                    d = max_diff + 1
                sd = 0
                if is_strong and test and n - d - m >= max(60, 5 * m):
                    after = tested_differences(gram, head, n, lags, d, 1, m, max_lag)
                    sd = int(after is not None and after["p_value"] < alpha)
                values = [test[c] if test else None for c in ("adf_stat", "p_value", "used_lags", "n_obs")]
                kept.append(i)
                out.append((scope, n, d, sd, *values))
            yield pd.concat([pdf[keys].iloc[kept].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    return found.mapInPandas(finish, f"{key_schema}, {fields}")


def adf_test(
    df: DataFrame,
    series: Series,
    col: str,
    alpha: float = ALPHA,
    split: bool | None = None,
    rows_per_chunk: int = GRAM_CHUNK_ROWS,
    max_lag: int | None = None,
) -> DataFrame:
    """Test with a constant and the lag order of least AIC, for every series at once; ``max_lag`` bounds the orders tried.

    Series shorter than 8 rows, and constant ones, are left out or get a null statistic.
    """
    keys = list(series.keys)
    rows = scope_rows(df, series, col)
    # the level is only known up to the constant, so centring changes nothing but the precision
    sizes = pin(scope_sizes(rows, series).where(F.col(SCOPE) == GLOBAL))
    longest = sizes.agg(F.max("n").alias("n")).first()["n"] or LEAST_ROWS
    lags = list(range(lags_wanted(longest, max_lag) + 2))
    joined = join_same(lag_matrices(rows, series, lags, split, rows_per_chunk), sizes, [*keys, SCOPE]).where(F.col("n") >= LEAST_ROWS)
    joined = joined.select(*keys, "gram", "head", "n")
    fields = "adf_stat double, p_value double, used_lags int, n_obs long, crit_1 double, crit_5 double, crit_10 double"
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*keys).schema.fields)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [
                tested_differences(np.asarray(g, float).reshape(len(lags) + 1, -1), np.asarray(h, float), int(n), lags, 0, max_lag=max_lag)
                for g, h, n in zip(pdf["gram"], pdf["head"], pdf["n"])
            ]
            out = pd.DataFrame(found, columns=[f.split()[0] for f in fields.split(", ")])
            yield pd.concat([pdf[keys].reset_index(drop=True), out], axis=1)

    out = joined.mapInPandas(finish, f"{key_schema}, {fields}")
    stat = F.when(~F.isnan("adf_stat"), F.col("adf_stat"))
    return out.withColumns({"adf_stat": stat, "p_value": F.when(stat.isNotNull(), F.col("p_value"))}).withColumn(
        "stationary", F.coalesce(F.col("p_value") < alpha, F.lit(False)).cast("int")
    )


def infer_d(df: DataFrame, series: Series, col: str, alpha: float = ALPHA, max_diff: int = MAX_DIFF, split=None) -> DataFrame:
    """How often each series must be differenced until the test accepts it, all orders from one pass."""
    keys = list(series.keys)
    found = differencing_by_scope(df, series, col, alpha=alpha, max_diff=max_diff, split=split).select(*keys, "d", "p_value")
    every = df.select(*keys).distinct()
    return join_same(every, found, keys, "left").select(*keys, F.coalesce("d", F.lit(max_diff + 1)).alias("d"), "p_value")


def infer_seasonal_d(
    df: DataFrame, series: Series, col: str, orders: DataFrame, strength: DataFrame, period: int, alpha=ALPHA, split=None
) -> DataFrame:
    """``sd`` per series: 1 when seasonality is strong, enough rows remain and the seasonal difference is stationary.

    ``orders`` gives ``d`` per series; all orders of differences come from one pass.
    """
    keys = list(series.keys)
    found, lags = tested_scopes(scope_rows(df, series, col), series, period, MAX_DIFF + 1, None, split)
    strong = strength.where("strong = 1").select(*keys).distinct()
    wanted = join_same(orders.select(*keys, "d"), strong, keys, "left_semi")
    work = join_same(found.where(F.col(SCOPE) == GLOBAL), wanted, keys).select(*keys, "gram", "head", "n", "d")
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.select(*keys).schema.fields)
    least = max(60, 5 * period)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for gram, head, n, d in zip(pdf["gram"], pdf["head"], pdf["n"], pdf["d"]):
                enough = n - d - period >= least
                test = tested_differences(np.asarray(gram, float).reshape(len(lags) + 1, -1), np.asarray(head, float), int(n), lags, int(d), 1, period) if enough else None
                found.append(int(test is not None and test["p_value"] < alpha))
            yield pdf[keys].assign(_sd=found)

    passed = work.mapInPandas(finish, f"{key_schema}, _sd int")
    return join_same(orders, passed, keys, "left").select(*keys, "d", F.coalesce("_sd", F.lit(0)).alias("sd"))


def stationarity_table(
    df: DataFrame, series: Series, col: str, period_of: dict[str, int], label: str = "freq", alpha=ALPHA, split=None
) -> DataFrame:
    """Verdict per series and resampling label; ``label`` is one of the series keys."""
    keys = list(series.keys)
    known = settle(df.where(F.col(col).isNotNull()))
    period = F.coalesce(*[F.when(F.col(label) == k, F.lit(m)) for k, m in period_of.items()], F.lit(1))
    sizes = known.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= 2 * period)
    tested = adf_test(join_same(known, sizes.where("enough").select(*keys), keys, "left_semi"), series, col, alpha, split)
    out = join_same(sizes, tested.select(*keys, "p_value", "stationary"), keys, "left")
    verdict = (
        F.when(~F.col("enough") | F.col("stationary").isNull(), "Not enough data")
        .when(F.col("stationary") == 1, "Yes")
        .otherwise("No")
    )
    return out.select(*keys, "n", "p_value", verdict.alias("stationary"))

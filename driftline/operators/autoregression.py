"""Order search, fitting and forecasting of (seasonal) autoregressions and moving averages by conditional least squares.

Moving-average terms take two stages: the residuals of a long autoregression stand in for the unseen shocks, and values are
regressed on lagged values and lagged residuals. The first stage comes from the cross products of raw lags of all scopes,
the second from one more pass, in which each chunk filters its own rows and those in front of it.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.backtest import top_n_by
from driftline.operators.lagsums import GRAM_CHUNK_ROWS, solve
from driftline.operators.ordered import Series, over_series
from driftline.operators.scopes import GLOBAL, SCOPE, difference_weights, lag_matrices, lagged, mapped, products, reduce_scopes, scope_rows, scope_sizes, shifted
from driftline.session import join_same, pin, settle

TOP = 5
LONG = 8  # least order of the long autoregression, before the two more that every order gets


def candidate_orders(df: DataFrame, period: int | None = None) -> DataFrame:
    """Rows of ``df`` (with suggested ``p`` and, if seasonal, ``sp``) fanned out to {0, 1, suggested} per order."""
    out = df.withColumn("p", F.explode(F.array_distinct(F.array(F.lit(0), F.lit(1), F.col("p")))))
    if period:
        out = out.withColumn("sp", F.explode(F.array_distinct(F.array(F.lit(0), F.lit(1), F.col("sp")))))
        return out.withColumn("m", F.lit(period))
    return out.withColumns({"sp": F.lit(0), "m": F.lit(0)})


def grid_of(p_max: int, sp_max: int = 0) -> list[tuple[int, int]]:
    """All (p, sp) up to the given bounds."""
    return [(p, sp) for p in range(p_max + 1) for sp in range(sp_max + 1)]


def lag_lists(p: int, q: int, sp: int, sq: int, m: int) -> tuple[list[int], list[int]]:
    """Lags of values and of residuals that orders up to these need."""
    return tuple(sorted({*range(1, max(1, k) + 1), *({m * j for j in range(1, max(1, s) + 1)} if m else ())}) for k, s in ((p, sp), (q, sq)))


def long_order(p: int, q: int, sp: int, sq: int, m: int) -> int:
    return max(LONG, p, q, m * max(1, sp, sq)) + 2


def residual_products(weights: np.ndarray, const: float, long: np.ndarray, ar: list[int], ma: list[int], values: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """Cross products of (1, lagged differences, lagged residuals, difference) over the rows from ``first`` on that have all."""
    lost, h = len(weights) - 1, len(long)
    start = max(first, lost + h + max(ma, default=0), lost + max(ar, default=0))
    if start >= len(values):
        return np.zeros((len(ar) + len(ma) + 2,) * 2), 0
    w = np.convolve(values, weights, "valid")  # w[i] belongs to row i + lost
    e = np.convolve(w, np.r_[1.0, -long], "valid") - const  # e[i] to row i + lost + h
    stop = len(values)
    x = [lagged(w, start - lost, stop - lost, ar), lagged(e, start - lost - h, stop - lost - h, ma)[:, 1:], w[start - lost :, None]]
    return products(np.hstack(x)), stop - start


def level_weights(weights: np.ndarray, const: float, long: np.ndarray, beta: np.ndarray, ar: list[int], ma: list[int]) -> tuple[float, np.ndarray]:
    """Constant and weights of lags 1, 2, ... of the undifferenced value: residuals are weighted sums of values as well."""
    poly = np.zeros(1 + max([0, *ar, *(k + len(long) for k in ma)]))
    poly[0] = 1.0
    total = float(beta[0])
    for k, b in zip(ar, beta[1:]):
        poly[k] -= b
    for k, b in zip(ma, beta[1 + len(ar) :]):
        poly[k : k + 1 + len(long)] -= b * np.r_[1.0, -long]
        total -= b * const
    return total, -np.convolve(poly, weights)[1:]


HINTS = ("p", "q", "sp", "sq", "d", "sd")


def search_orders(
    df: DataFrame,
    series: Series,
    col: str,
    hints: DataFrame,
    m: int = 0,
    regime: str | None = None,
    long: int | None = None,
    split: bool | None = None,
    rows_per_chunk: int = GRAM_CHUNK_ROWS,
) -> DataFrame:
    """AIC and BIC of all candidate orders for each whole series and each of its regimes.

    ``hints`` has one row per (keys, scope) with suggested p, q, sp, sq and the differencing orders d, sd; candidates are 0, 1
    and the suggestion of each. ``model`` is ARIMA (no seasonal part) or, with a period ``m``, SARIMA as well. Orders of one
    scope and model share one sample, so their criteria compare; scopes with too few rows for their longest design are left
    out. ``coef`` and ``const`` weigh lags 1, 2, ... of the undifferenced value. ``long`` fixes the first stage's order.
    """
    keys = list(series.keys)
    hints = pin(hints.select(*keys, SCOPE, *[F.col(c).cast("int").alias(c) for c in HINTS]))
    top = hints.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in HINTS]).first()
    first_order = long or long_order(top["p"], top["q"], top["sp"], top["sq"], m)
    lost = top["d"] + m * top["sd"]
    reach = lost + first_order + max(sum(lag_lists(top["p"], top["q"], top["sp"], top["sq"], m), []))
    rows = settle(scope_rows(df, series, col, regime))
    lags = list(range(lost + first_order + 1))
    by = [*keys, SCOPE]
    sizes = scope_sizes(rows, series)
    known = join_same(join_same(lag_matrices(rows, series, lags, split, rows_per_chunk), sizes, by), hints, by)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.select(*keys).schema.fields)

    def first_stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kept, out = [], []
            for i, row in enumerate(pdf.to_dict("records")):
                p, q, sp, sq, d, sd = (int(row[c]) for c in HINTS)
                gram, head = np.asarray(row["gram"], float).reshape(len(lags) + 1, -1), np.asarray(row["head"], float)
                for model, seasonal, period in [("ARIMA", 0, 0), ("SARIMA", sd, m)][: 2 if m else 1]:
                    weights = difference_weights(d, seasonal, m)
                    h = long or (long_order(p, q, sp, sq, period) if period else long_order(p, q, 0, 0, 0))
                    ar, ma = lag_lists(p, q, sp, sq, period)
                    if row["n"] < len(weights) + h + max(ar + ma) + 2 * (len(ar) + len(ma)) + 10:
                        continue
                    full = mapped(gram, lags, [*[shifted(weights, k) for k in range(1, h + 1)], weights])
                    w = np.convolve(head, weights, "valid") if len(head) >= len(weights) else np.empty(0)
                    if len(w) > h:
                        x = np.hstack([lagged(w, h, len(w), range(1, h + 1)), w[h:, None]])
                        full = full + x.T @ x
                    beta, _, _ = solve(full, list(range(h + 1)), h + 1)
                    kept.append(i)
                    out.append((row[SCOPE], model, [p, q, sp, sq, d, seasonal, period, *beta]))
            yield pd.concat([pdf[keys].iloc[kept].reset_index(drop=True), pd.DataFrame(out, columns=[SCOPE, "variant", "given"])], axis=1)

    given = settle(known.mapInPandas(first_stage, f"{key_schema}, {SCOPE} string, variant string, given array<double>"))

    def parts(told: np.ndarray) -> tuple[list[int], np.ndarray, float, np.ndarray, list[int], list[int]]:
        orders = [int(x) for x in told[:7]]
        p, q, sp, sq, d, sd, period = orders
        return orders, difference_weights(d, sd, period), float(told[7]), np.asarray(told[8:], float), *lag_lists(p, q, sp, sq, period)

    def second_stage(scope: str, values: np.ndarray, first: int, known: dict) -> list[tuple[str, np.ndarray, int]]:
        out = []
        for variant, told in known.items():
            _, weights, const, own, ar, ma = parts(told)
            out.append((variant, *residual_products(weights, const, own, ar, ma, values, first)))
        return out

    sums = reduce_scopes(rows, series, reach, second_stage, given, split, rows_per_chunk).where("n_used > 0")
    means = pin(df.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias("_mean")))
    work = join_same(join_same(sums.drop("head"), given, [*by, "variant"]), means, keys).select(*by, "variant", "gram", "n_used", "given", "_mean")
    fields = f"{SCOPE} string, model string, p int, d int, q int, sp int, sd int, sq int, m int, n_used long, aic double, bic double, sigma2 double, const double, coef array<double>"
    names = [f.split()[0] for f in fields.split(", ")]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kept, out = [], []
            for i, row in enumerate(pdf.to_dict("records")):
                (p, q, sp, sq, d, sd, period), weights, const, own, ar, ma = parts(row["given"])
                size, n = len(ar) + len(ma) + 2, int(row["n_used"])
                gram = np.asarray(row["gram"], float).reshape(size, size)
                seasonal = [sorted({0, 1, k}) if period else [0] for k in (sp, sq)]
                for a, b, c, e in itertools.product(sorted({0, 1, p}), sorted({0, 1, q}), *seasonal):
                    use_ar, use_ma = ([k for k in lags_ if k <= o or (period and k % period == 0 and k // period <= s)] for lags_, o, s in ((ar, a, c), (ma, b, e)))
                    cols = [0, *[1 + ar.index(k) for k in use_ar], *[1 + len(ar) + ma.index(k) for k in use_ma]]
                    beta, ssr, _ = solve(gram, cols, size - 1)
                    sigma2, free = max(ssr / n, 1e-300), len(cols) + 1
                    fitness = n * (math.log(2 * math.pi) + math.log(sigma2) + 1)
                    total, coef = level_weights(weights, const, own, beta, use_ar, use_ma)
                    total += float(row["_mean"]) * (1 - coef.sum())
                    kept.append(i)
                    out.append((row[SCOPE], row["variant"], a, d, b, c, sd, e, period, n, fitness + 2 * free, fitness + free * math.log(n), sigma2, total, coef.tolist()))
            yield pd.concat([pdf[keys].iloc[kept].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    return work.mapInPandas(fit, f"{key_schema}, {fields}")


def order_grid_search(
    train: DataFrame,
    series: Series,
    col: str,
    orders: Sequence[tuple[int, int]],
    d: int = 0,
    sd: int = 0,
    m: int = 0,
    split: bool | None = None,
    rows_per_chunk: int = GRAM_CHUNK_ROWS,
) -> DataFrame:
    """AIC, BIC and coefficients for each (series, p, sp) on the differenced training rows.

    All orders share one pass over the data and one sample, so their criteria compare; differences are taken in the cross
    products. ``coef`` holds the weights of lags 1, 2, ... on the undifferenced value, ``const`` the constant.
    """
    keys = list(series.keys)
    weights = difference_weights(d, sd, m)
    lost = len(weights) - 1
    lags = sorted({k for p, _ in orders for k in range(1, p + 1)} | {k * m for _, sp in orders for k in range(1, sp + 1) if m})
    reach = max(lags, default=0)
    raw = sorted({j + k for j in (0, *lags) for k in np.flatnonzero(weights).tolist()})
    rows = scope_rows(train, series, col)
    sizes = scope_sizes(rows, series).where(F.col(SCOPE) == GLOBAL)
    means = pin(train.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias("_mean")))
    sums = join_same(lag_matrices(rows, series, raw, split, rows_per_chunk), sizes, [*keys, SCOPE]).where(F.col("n") - lost > 2 * reach + 10)
    sums = join_same(sums, means, keys)
    todo = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(sp).alias("sp")) for p, sp in orders])).alias("_o")
    work = sums.select(*keys, "gram", "n_used", "_mean", todo).select(*keys, "gram", "n_used", "_mean", "_o.*")
    fields = "p int, d int, q int, sp int, sd int, sq int, m int, n_used long, aic double, bic double, sigma2 double, const double, coef array<double>"
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.select(*keys).schema.fields)
    names = [f.split()[0] for f in fields.split(", ")]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*[shifted(weights, k) for k in lags], weights]
        for pdf in batches:
            found = []
            for gram, n, mean, p, sp in zip(pdf["gram"], pdf["n_used"], pdf["_mean"], pdf["p"], pdf["sp"]):
                use = [k for k in lags if k <= p or (m and k % m == 0 and k // m <= sp)]
                cols = [0] + [1 + lags.index(k) for k in use]
                full = mapped(np.asarray(gram, dtype=float).reshape(len(raw) + 1, -1), raw, columns)
                beta, ssr, _ = solve(full, cols, len(lags) + 1)
                n, k = int(n), len(cols) + 1
                sigma2 = max(ssr / n, 1e-300)
                fitness = n * (math.log(2 * math.pi) + math.log(sigma2) + 1)
                ar = np.zeros(reach + 1)
                ar[0] = 1.0
                for lag, b in zip(use, beta[1:]):
                    ar[lag] = -b
                poly = np.convolve(ar, weights)
                const = float(beta[0] + mean * poly.sum())
                level = (-poly[1:]).tolist()
                found.append((p, d, 0, sp, sd, 0, m, n, fitness + 2 * k, fitness + k * math.log(n), sigma2, const, level))
            out = pd.DataFrame(found, columns=names)
            yield pd.concat([pdf[keys].reset_index(drop=True), out], axis=1)

    return work.mapInPandas(fit, f"{key_schema}, {fields}")


def short_list(grid: DataFrame, keys: Sequence[str], n: int = TOP) -> DataFrame:
    """Orders among the best ``n`` by AIC or by BIC; the grid is read once per criterion, so it is settled first."""
    return top_n_by(settle(grid), keys, ["aic", "bic"], n, ["p", "q", "sp", "sq"])


def best_fit(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order of least AIC per series."""
    rest = [c for c in grid.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct("aic", "p", "q", "sp", "sq"))
    return grid.groupBy(*keys).agg(row.alias("_b")).select(*keys, "_b.*")


def one_step_forecast(df: DataFrame, series: Series, col: str, fits: DataFrame, reach: int, split: bool | None = None):
    """Forecast of every row from the ``reach`` values before it, with the coefficients of its series."""
    keys = list(series.keys)
    rows = over_series(
        df,
        series,
        lambda w: {"_past": F.array(*[F.lag(F.col(col).cast("double"), k).over(w) for k in range(1, reach + 1)])},
        back=reach,
        split=split,
    )
    known = join_same(rows, pin(fits.select(*keys, "const", "coef")), keys)
    terms = F.zip_with(F.slice("_past", F.lit(1), F.size("coef")), F.col("coef"), lambda x, b: F.when(b == 0, F.lit(0.0)).otherwise(x * b))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return known.withColumns({"y_pred": F.col("const") + total, "y_true": F.col(col)}).drop("_past", "const", "coef")


def forecast_ahead(tail: DataFrame, series: Series, col: str, fits: DataFrame, steps: int) -> DataFrame:
    """The next ``steps`` values after the last row of each series, from its last few rows only.

    ``tail`` may be the whole series: the rank limit keeps as many rows per series as there are coefficients.
    """
    keys = list(series.keys)
    fits = pin(fits.select(*keys, "const", "coef"))
    reach = fits.agg(F.max(F.size("coef")).alias("k")).first()["k"] or 1
    last = tail.withColumn("_rn", F.row_number().over(series.window(descending=True))).where(F.col("_rn") <= reach)
    past = last.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(col).cast("double").alias("_v")))), lambda s: s["_v"]).alias("_past")
    )
    work = join_same(past, fits, keys)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.select(*keys).schema.fields)

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(len(pdf)):
                row = pdf.iloc[i]
                coef, seen = np.asarray(row["coef"], dtype=float), list(row["_past"])
                if len(seen) < len(coef):
                    continue
                made = []
                for _ in range(steps):
                    made.append(float(row["const"] + coef @ np.asarray(seen[: len(coef)])))
                    seen.insert(0, made[-1])
                yield pd.DataFrame({**{k: [row[k]] * steps for k in keys}, "step": range(1, steps + 1), "y_pred": made})

    return work.mapInPandas(roll, f"{key_schema}, step int, y_pred double")

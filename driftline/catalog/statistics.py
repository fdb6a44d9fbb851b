"""Time-series statistics over many series at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import BARS, DAILY_SQL, Shape, daily, prices, query
from driftline.functions.temporal import safe_lag
from driftline.operators import autoregression, boxcox, buckets, correlogram, decomposition, unit_root
from driftline.operators.backtest import forecast_metrics, time_split
from driftline.operators.ordered import Series
from driftline.session import join_same, settle
from driftline.catalog.backtests import SCOPED, SCOPES_SQL, scoped

RET_SQL = f"""{DAILY_SQL}, ret0 AS (SELECT series_id, ts, ln(price) - lag(ln(price)) OVER (PARTITION BY series_id ORDER BY ts) AS x FROM daily),
  ret AS (SELECT * FROM ret0 WHERE x IS NOT NULL)"""


def acf_sql(source: str, lags, keys: str = "series_id", value: str = "x") -> str:
    return f"""acf AS (WITH c AS (SELECT {keys}, ts, {value} - avg({value}) OVER (PARTITION BY {keys}) AS v,
      row_number() OVER (PARTITION BY {keys} ORDER BY ts) AS i FROM {source} WHERE {value} IS NOT NULL),
      base AS (SELECT {keys}, count(*) AS n, sum(v * v) AS xx FROM c GROUP BY ALL),
      lags AS (SELECT unnest({list(lags)}) AS lag)
      SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, lags.lag, any_value(n) AS n, sum(a.v * b.v) / any_value(xx) AS acf
      FROM c a JOIN lags ON true JOIN c b ON {' AND '.join(f'a.{k.strip()} = b.{k.strip()}' for k in keys.split(','))} AND b.i = a.i + lags.lag
      JOIN base ON {' AND '.join(f'a.{k.strip()} = base.{k.strip()}' for k in keys.split(','))} GROUP BY ALL)"""


def daily_returns(spark, d):
    from driftline.operators.rolling import returns

    return returns(daily(spark, d), BARS, "price", "log", out="x").select("series_id", "ts", "x")


ACF = Shape("series_id", "lag n", ((6, "acf"),))


@query(ACF, f"WITH {RET_SQL}, {acf_sql('ret', range(1, 31))} FINAL SELECT * FROM acf")
def return_acf(spark, d):
    return correlogram.acf(daily_returns(spark, d), BARS, "x", range(1, 31))


@query(ACF, f"WITH {RET_SQL}, {acf_sql('ret', [1, 7, 30])} FINAL SELECT * FROM acf")
def return_acf_split(spark, d):
    series = Series(("series_id",), "ts", chunk_seconds=100 * 24 * 3600)
    return correlogram.acf(daily_returns(spark, d), series, "x", [1, 7, 30], split=True)


@query(
    Shape("series_id", "lag", ((6, "pacf"),)),
    f"""WITH {RET_SQL}, {acf_sql('ret', [1, 2, 3])}, w AS (SELECT series_id, max(acf) FILTER (lag = 1) AS a, max(acf) FILTER (lag = 2) AS b,
    max(acf) FILTER (lag = 3) AS c FROM acf GROUP BY 1)
    FINAL SELECT series_id, 1 AS lag, a AS pacf FROM w UNION ALL SELECT series_id, 2, (b - a * a) / (1 - a * a) FROM w UNION ALL
    SELECT series_id, 3, (pow(a, 3) - 2 * a * b + a * b * b + c - a * a * c) / (1 - 2 * a * a + 2 * a * a * b - b * b) FROM w""",
)
def return_pacf(spark, d):
    """The first three partial autocorrelations, which have a closed form."""
    rho = correlogram.acf(daily_returns(spark, d), BARS, "x", [1, 2, 3])
    return correlogram.pacf(rho, ["series_id"])


# plain orders look at the lags that are safe for daily rows, seasonal ones at multiples of 7 up to max(2 * 7, 60)
ORDERS_SQL = """marks AS (SELECT *, n >= 30 AND lag <= greatest(10, least(30, n - 2)) AS plain, n >= 60 AND lag % 7 = 0 AND lag <= least(60, n - 2) AS wide FROM {0}),
    {0}_orders AS (SELECT series_id, coalesce(min(lag) FILTER (plain AND abs({0}) > 1.96 / sqrt(n)), 0) AS first,
      CAST(coalesce(bool_or(abs({0}) > 1.96 / sqrt(n)) FILTER (wide), false) AS INT) AS season FROM marks GROUP BY 1)"""
# partial autocorrelations by the same recursion on lists
PACF_SQL = """pacf AS (WITH RECURSIVE r AS (SELECT series_id, any_value(n) AS n, list(acf ORDER BY lag) AS r FROM acf GROUP BY 1),
    grown AS (SELECT series_id, n, r, 1 AS lag, [r[1]] AS phi, 1 - r[1] * r[1] AS err, r[1] AS pacf FROM r UNION ALL
      SELECT series_id, n, r, lag + 1, list_concat(list_transform(phi, lambda f, i: f - g * phi[lag + 1 - i]), [g]), err * (1 - g * g), g
      FROM (SELECT *, (r[lag + 1] - list_sum(list_transform(phi, lambda f, i: f * r[lag + 1 - i]))) / err AS g FROM grown WHERE lag < len(r)))
    SELECT series_id, n, lag, pacf FROM grown)"""


def orders(spark, d):
    rho = settle(correlogram.acf(daily_returns(spark, d), BARS, "x", range(1, 61)))
    part = settle(correlogram.pacf(rho, ["series_id"]))
    short = F.col("lag") <= safe_lag("1-day", 7, F.col("n"))
    far = F.col("lag") <= F.col("n") - 2
    plain = correlogram.suggested_orders(rho.where(short), part.where(short), ["series_id"])
    return join_same(plain, correlogram.seasonal_orders(rho.where(far), part.where(far), ["series_id"], 7), ["series_id"])


@query(
    Shape("series_id", "q sq"),
    f"""WITH {RET_SQL}, {acf_sql('ret', range(1, 61))}, {ORDERS_SQL.format('acf')}
    FINAL SELECT series_id, first AS q, season AS sq FROM acf_orders""",
)
def suggested_ma_orders(spark, d):
    return orders(spark, d)


@query(
    Shape("series_id", "p q sp sq"),
    f"""WITH {RET_SQL}, {acf_sql('ret', range(1, 61))}, {PACF_SQL}, {ORDERS_SQL.format('acf')},
    {ORDERS_SQL.format('pacf').replace('marks', 'part_marks')}
    FINAL SELECT series_id, a.first AS q, a.season AS sq, b.first AS p, b.season AS sp FROM acf_orders a JOIN pacf_orders b USING (series_id)""",
)
def suggested_orders(spark, d):
    """All four orders, the ones from the partial autocorrelation included."""
    return orders(spark, d)


@query(
    Shape("series_id source", "period"),
    f"""WITH {DAILY_SQL}, dif0 AS (SELECT series_id, ts, price - lag(price) OVER (PARTITION BY series_id ORDER BY ts) AS x FROM daily),
    dif AS (SELECT * FROM dif0 WHERE x IS NOT NULL), {acf_sql('dif', [7, 14, 30, 90])},
    b AS (SELECT series_id, any_value(n) AS n, max(acf) AS r, arg_max(lag, acf) AS m FROM acf GROUP BY 1)
    FINAL SELECT series_id, CASE WHEN n >= 185 AND r >= greatest(0.02, 1.96 / sqrt(n)) THEN m ELSE 7 END AS period,
    CASE WHEN n >= 185 AND r >= greatest(0.02, 1.96 / sqrt(n)) THEN 'acf' ELSE 'first_candidate' END AS source FROM b""",
)
def inferred_periods(spark, d):
    return correlogram.infer_period(daily(spark, d), BARS, "price", "1-day")


def decompose_sql(source: str, m: int, keys: str = "series_id", value: str = "x") -> str:
    h = m // 2
    frame = f"(PARTITION BY {keys} ORDER BY ts ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    order = f"(PARTITION BY {keys} ORDER BY ts)"
    ends = f" - 0.5::DOUBLE * (lag({value}, {h}) OVER {order} + lead({value}, {h}) OVER {order})" if m % 2 == 0 else ""
    using = keys.replace(" ", "")
    return f"""d0 AS (SELECT {keys}, ts, {value} AS v, row_number() OVER {order} AS i, count(*) OVER (PARTITION BY {keys}) AS n,
      CASE WHEN count({value}) OVER {frame} = {2 * h + 1} THEN (sum({value}) OVER {frame}{ends}) / {m} END AS trend FROM {source}),
    d1 AS (SELECT *, (i - 1) % {m} AS pos FROM d0 WHERE n >= {2 * m}),
    pat0 AS (SELECT {keys}, pos, avg(v - trend) AS s FROM d1 GROUP BY ALL),
    pat AS (SELECT {keys}, pos, s - avg(s) OVER (PARTITION BY {keys}) AS seasonal FROM pat0),
    dec AS (SELECT d1.*, seasonal, v - trend - seasonal AS resid FROM d1 JOIN pat USING ({using}, pos))"""


DECOMPOSED = Shape("series_id ts", "row_no", ((6, "trend seasonal resid"),))


@query(DECOMPOSED, f"WITH {RET_SQL}, {decompose_sql('ret', 7)} FINAL SELECT *, i AS row_no FROM dec")
def weekly_decomposition(spark, d):
    return decomposition.seasonal_decompose(daily_returns(spark, d), BARS, "x", 7)


@query(DECOMPOSED, f"WITH {RET_SQL}, {decompose_sql('ret', 14)} FINAL SELECT *, i AS row_no FROM dec")
def fortnight_decomposition_split(spark, d):
    series = Series(("series_id",), "ts", chunk_seconds=100 * 24 * 3600)
    return decomposition.seasonal_decompose(daily_returns(spark, d), series, "x", 14, split=True)


STRENGTH_SQL = f"""{SCOPES_SQL}, ret0 AS (SELECT series_id, scope, ts, ln(price) - lag(ln(price)) OVER (PARTITION BY series_id, scope ORDER BY ts) AS x FROM scoped),
  ret AS (SELECT * FROM ret0 WHERE x IS NOT NULL), {decompose_sql('ret', 7, 'series_id, scope')}, {acf_sql('ret', [7], 'series_id, scope')},
  strength AS (SELECT series_id, scope, count(*) AS n, CASE WHEN count(*) >= 14 THEN var_pop(seasonal) / var_pop(v) END AS var_ratio,
    CASE WHEN count(*) >= 14 THEN any_value(acf) END AS acf_at_period FROM dec JOIN acf USING (series_id, scope) GROUP BY 1, 2)"""


def strengths(spark, d):
    from driftline.operators.rolling import returns

    got = returns(scoped(spark, d), SCOPED, "price", "log", out="x")
    return decomposition.seasonality_strength(decomposition.seasonal_decompose(got, SCOPED, "x", 7), SCOPED, "x", 7)


@query(
    Shape("series_id scope", "n strong", ((6, "var_ratio acf_at_period"),)),
    f"WITH {STRENGTH_SQL} FINAL SELECT *, CAST(coalesce(var_ratio >= 0.02 AND acf_at_period >= 0.2, false) AS INT) AS strong FROM strength",
)
def seasonality_strengths(spark, d):
    return strengths(spark, d)


@query(
    Shape("series_id strategy", "n_regimes", ((6, "frac_var frac_acf"),)),
    f"""WITH {STRENGTH_SQL}, g AS (SELECT * FROM strength WHERE scope = 'GLOBAL'), j AS (SELECT g.series_id, g.var_ratio AS gv, g.acf_at_period AS ga, count(r.var_ratio) AS n_regimes,
      avg(CAST(abs(r.var_ratio - g.var_ratio) > 0.01 AS INT)) AS frac_var, avg(CAST(abs(r.acf_at_period - g.acf_at_period) > 0.10 AS INT)) AS frac_acf
      FROM g LEFT JOIN strength r ON g.series_id = r.series_id AND r.scope <> 'GLOBAL' AND r.var_ratio IS NOT NULL GROUP BY 1, 2, 3)
    FINAL SELECT *, CASE WHEN n_regimes = 0 THEN 'global' WHEN gv < 0.01 AND abs(ga) < 0.10 AND frac_var < 0.25 AND frac_acf < 0.25 THEN 'global'
      WHEN frac_var > 0.6 OR frac_acf > 0.6 THEN 'per_regime' ELSE 'mixed' END AS strategy FROM j""",
)
def seasonality_strategies(spark, d):
    all_ = strengths(spark, d)
    return decomposition.strategy_choice(all_.where("scope = 'GLOBAL'"), all_.where("scope <> 'GLOBAL'"), ["series_id"])


@query(
    Shape("series_id", "lag n", ((4, "q_stat"),)),
    f"""WITH {RET_SQL}, {acf_sql('ret', range(1, 31))}, marks AS (SELECT unnest([2, 7, 14, 30]) AS cut)
    FINAL SELECT series_id, cut AS lag, any_value(n) AS n, any_value(n) * (any_value(n) + 2) * sum(acf * acf / (n - lag)) AS q_stat
    FROM acf JOIN marks ON lag <= cut GROUP BY 1, 2""",
)
def ljung_box_statistics(spark, d):
    return correlogram.ljung_box(daily_returns(spark, d), BARS, "x", [2, 7, 14, 30])


def tail_sql(x: str, k: str) -> str:
    """Upper tail of the chi-square distribution: one minus the power series of the incomplete gamma function."""
    term = f"exp(({k} / 2.0::DOUBLE + j) * ln({x} / 2) - {x} / 2 - lgamma({k} / 2.0::DOUBLE + j + 1))"
    return f"CASE WHEN {x} <= 0 THEN 1 ELSE greatest(0, 1 - list_sum([{term} for j in range(0, CAST({x} AS BIGINT) + 100)])) END"


def ljung_sql(acf: str, cuts: list[int], out: str) -> str:
    """Statistic and p-value per series and number of lags."""
    return f"""{out} AS (WITH cuts AS (SELECT unnest({cuts}) AS cut), s AS (SELECT series_id, cut AS lag, any_value(n) AS n,
      any_value(n) * (any_value(n) + 2) * sum(acf * acf / (n - lag)) AS q_stat FROM {acf} JOIN cuts ON lag <= cut AND cut < n - 2 GROUP BY 1, 2)
      SELECT *, {tail_sql('q_stat', 'lag')} AS p_value FROM s)"""


@query(
    Shape("series_id", "lag n", ((5, "q_stat p_value"),)),
    f"WITH {RET_SQL}, {acf_sql('ret', range(1, 31))}, {ljung_sql('acf', [2, 7, 14, 30], 'lb')} FINAL SELECT * FROM lb",
)
def ljung_box_p_values(spark, d):
    return correlogram.ljung_box(daily_returns(spark, d), BARS, "x", [2, 7, 14, 30])


@query(
    Shape("series_id", "n no_trend no_period centred", ((9, "slope"), (6, "mean max_acf"))),
    f"""WITH {RET_SQL}, {decompose_sql('ret', 7)}, res AS (SELECT series_id, ts, resid AS x FROM dec WHERE resid IS NOT NULL), {acf_sql('res', range(1, 15))},
    peak AS (SELECT series_id, max(abs(acf)) AS max_acf FROM acf GROUP BY 1),
    num AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS i FROM res),
    b AS (SELECT series_id, count(*) AS n, regr_slope(x, i) AS slope, avg(x) AS mean, stddev_pop(x) AS sp, stddev_samp(x) AS ss FROM num GROUP BY 1)
    FINAL SELECT *, CAST(abs(slope) < greatest(sp * 0.01, 1e-6) AS INT) AS no_trend, CAST(max_acf < 0.3 AS INT) AS no_period,
    CAST(abs(mean) < greatest(ss * 0.05, 1e-6) AS INT) AS centred FROM b JOIN peak USING (series_id)""",
)
def residual_checks(spark, d):
    dec = decomposition.seasonal_decompose(daily_returns(spark, d), BARS, "x", 7)
    return decomposition.residual_diagnostics(dec, BARS, "resid", 7, "1-day")


@query(
    Shape("series_id", "n max_acf_lag no_trend no_period centred white_noise volatility_effect", ((9, "slope"), (6, "mean max_acf lb_min_p lb_abs_min_p"))),
    f"""WITH {RET_SQL}, {decompose_sql('ret', 7)}, res AS (SELECT series_id, ts, resid AS x, abs(resid) AS y FROM dec WHERE resid IS NOT NULL),
    {acf_sql('res', range(1, 31))}, {acf_sql('res', range(1, 31), value='y').replace('acf AS', 'acf_y AS', 1)},
    {ljung_sql('acf', [2, 7, 14, 30], 'lb')}, {ljung_sql('acf_y', [2, 7, 14, 30], 'lb_y')},
    white AS (SELECT series_id, min(p_value) AS lb_min_p FROM lb GROUP BY 1), calm AS (SELECT series_id, min(p_value) AS lb_abs_min_p FROM lb_y GROUP BY 1),
    peak AS (SELECT series_id, max(abs(acf)) AS max_acf, arg_max(lag, abs(acf)) AS max_acf_lag FROM acf WHERE lag <= 14 GROUP BY 1),
    num AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS i FROM res),
    b AS (SELECT series_id, count(*) AS n, regr_slope(x, i) AS slope, avg(x) AS mean, stddev_pop(x) AS sp, stddev_samp(x) AS ss FROM num GROUP BY 1)
    FINAL SELECT *, CAST(abs(slope) < greatest(sp * 0.01, 1e-6) AS INT) AS no_trend, CAST(max_acf < 0.3 AS INT) AS no_period,
    CAST(abs(mean) < greatest(ss * 0.05, 1e-6) AS INT) AS centred, CAST(lb_min_p > 0.05 AS INT) AS white_noise,
    CAST(lb_abs_min_p <= 0.05 AS INT) AS volatility_effect FROM b JOIN peak USING (series_id) JOIN white USING (series_id) JOIN calm USING (series_id)""",
)
def residual_verdicts(spark, d):
    """With the whiteness and volatility verdicts."""
    dec = decomposition.seasonal_decompose(daily_returns(spark, d), BARS, "x", 7)
    return decomposition.residual_diagnostics(dec, BARS, "resid", 7, "1-day")


@query()
def stationarity_tests(spark, d):
    return unit_root.adf_test(daily(spark, d), BARS, "price")


@query()
def differencing_orders(spark, d):
    whole = daily(spark, d)
    orders = unit_root.infer_d(whole, BARS, "price")
    strength = decomposition.seasonality_strength(decomposition.seasonal_decompose(whole, BARS, "price", 7), BARS, "price", 7)
    return unit_root.infer_seasonal_d(whole, BARS, "price", orders, strength, 7)


RESAMPLED = Series(("series_id", "freq"), "bucket")
PERIODS = {"1 hour": 24, "4 hours": 6, "1 day": 7, "month": 12, "quarter": 4, "year": 1}


@query()
def stationarity_by_resampling(spark, d):
    means = buckets.resample_mean(prices(spark, d), ["series_id"], "ts", list(PERIODS), ["price"])
    return unit_root.stationarity_table(means, RESAMPLED, "price", PERIODS)


@query(
    Shape("series_id recommendation note", "n", ((1, "lam"),)),
    f"""WITH {DAILY_SQL}, b AS (SELECT series_id, count(*) AS n, avg(ln(price)) AS lg, min(price) AS mn FROM daily GROUP BY 1),
    s AS (SELECT series_id, n, exp(ln(price) - lg) AS y FROM daily JOIN b USING (series_id) WHERE mn > 0),
    g AS (SELECT unnest(generate_series(-3000, 3000, 1)) / 1000.0::DOUBLE AS l),
    f AS (SELECT series_id, l, any_value(n) AS n, -any_value(n) / 2 * ln(var_pop(CASE WHEN abs(l) < 1e-9 THEN ln(y) ELSE (pow(y, l) - 1) / l END)) AS ll FROM s, g GROUP BY 1, 2),
    m AS (SELECT series_id, any_value(n) AS n, arg_max(l, ll) AS lam FROM f GROUP BY 1)
    FINAL SELECT series_id, n, lam, CASE WHEN abs(lam - 1) < 0.2 THEN 'keep' WHEN abs(lam) < 0.2 THEN 'log'
    ELSE 'power' END AS recommendation, 'ok' AS note FROM m""",
)
def boxcox_exponents(spark, d):
    return boxcox.boxcox_lambda(daily(spark, d), ["series_id"], "price")


@query(
    Shape("series_id", "p n_used", ((4, "aic bic"), (2, "sigma2 const"), (6, "phi"))),
    f"""WITH {DAILY_SQL}, s AS (SELECT series_id, price AS y, lag(price) OVER (PARTITION BY series_id ORDER BY ts) AS x FROM daily),
    k AS (SELECT * FROM s WHERE x IS NOT NULL),
    f AS (SELECT series_id, 0 AS p, count(*) AS n, var_pop(y) AS sigma2, avg(y) AS const, 0.0 AS phi, 2 AS k FROM k GROUP BY 1 UNION ALL
      SELECT series_id, 1, count(*), regr_syy(y, x) / count(*) * (1 - regr_r2(y, x)), regr_intercept(y, x), regr_slope(y, x), 3 FROM k GROUP BY 1)
    FINAL SELECT *, n AS n_used, n * (ln(2 * pi()) + ln(sigma2) + 1) + 2 * k AS aic, n * (ln(2 * pi()) + ln(sigma2) + 1) + k * ln(n) AS bic FROM f""",
)
def first_order_fits(spark, d):
    """Orders 0 and 1, which plain regression aggregates reproduce."""
    grid = autoregression.order_grid_search(daily(spark, d), BARS, "price", [(0, 0), (1, 0)])
    return grid.withColumn("phi", F.col("coef")[0])


@query()
def order_search(spark, d):
    """Best five seasonal orders per series by either criterion, on the training part."""
    train = time_split(daily(spark, d), BARS, 0.05).where("part = 'train'").drop("row_no", "n_rows", "split_at", "part")
    grid = autoregression.order_grid_search(train, BARS, "price", autoregression.grid_of(3, 1), d=1, m=7)
    return autoregression.short_list(grid, ["series_id"]).drop("coef")


@query()
def fitted_forecast_metrics(spark, d):
    """One-step forecasts of the test part by the order of least AIC, against the training scale."""
    parts = settle(time_split(daily(spark, d), BARS, 0.05))
    train = parts.where("part = 'train'").select("series_id", "ts", "price")
    grid = autoregression.order_grid_search(train, BARS, "price", autoregression.grid_of(2, 1), d=1, m=7)
    fits = autoregression.best_fit(grid, ["series_id"])
    from driftline.operators.backtest import naive_forecast

    scale = naive_forecast(train, BARS, "price").groupBy("series_id").agg(F.avg("_step").alias("train_scale"))
    ahead = autoregression.one_step_forecast(parts, BARS, "price", fits, 8).where("part = 'test'")
    return forecast_metrics(ahead.join(scale, "series_id"), ["series_id"])


@query()
def forecast_paths(spark, d):
    whole = daily(spark, d)
    grid = autoregression.order_grid_search(whole, BARS, "price", autoregression.grid_of(2, 1), d=1, m=7)
    return autoregression.forecast_ahead(whole, BARS, "price", autoregression.best_fit(grid, ["series_id"]), 14)

"""Unit roots, differencing and order search for whole series and their regimes, from one pass of lag matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.backtests import SCOPED
from driftline.catalog.base import BARS, DAILY_SQL, Shape, daily, query
from driftline.catalog.statistics import strengths
from driftline.catalog.timejoins import EDGES
from driftline.operators import autoregression, correlogram, unit_root
from driftline.operators.joins import assign_regime
from driftline.session import settle

# where the p-value of the test passes five percent
TAU = "-2.8615927630969753"

HALF_OPEN_SQL = f"""{DAILY_SQL}, bounds AS (SELECT min(ts) AS lo, max(ts) AS hi FROM daily),
  marks AS (SELECT lo AS t FROM bounds UNION SELECT hi FROM bounds UNION SELECT unnest({EDGES})::TIMESTAMP),
  cuts AS (SELECT t FROM marks, bounds WHERE t BETWEEN lo AND hi),
  regimes AS (SELECT row_number() OVER (ORDER BY t) AS id, t AS a, lead(t) OVER (ORDER BY t) AS z FROM cuts QUALIFY z IS NOT NULL),
  whole AS (SELECT series_id, ts, price - avg(price) OVER (PARTITION BY series_id) AS y FROM daily),
  scoped AS (SELECT series_id, 'GLOBAL' AS scope, ts, y FROM whole UNION ALL
    SELECT series_id, 'REGIME_' || id, ts, y FROM whole, regimes, bounds WHERE ts >= a AND (ts < z OR z = hi))"""


def regimed(spark, d):
    """Daily prices with the regime they fall in; every row has one."""
    rows = assign_regime(daily(spark, d).select("series_id", "ts", "price"), "ts", EDGES)
    return rows.select("series_id", "ts", "price", F.concat(F.lit("REGIME_"), F.col("regime_id")).alias("regime"))


@query(
    Shape("series_id", "used_lags n_obs stationary", ((5, "adf_stat"),)),
    f"""WITH {DAILY_SQL}, s AS (SELECT series_id, ts, price - avg(price) OVER (PARTITION BY series_id) AS y FROM daily),
    r AS (SELECT series_id, y - lag(y) OVER w AS dy, lag(y) OVER w AS x, lag(y) OVER w - lag(y, 2) OVER w AS l FROM s WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
    f AS (SELECT series_id, count(*) AS n, var_pop(x) AS sxx, var_pop(dy) AS syy, covar_pop(x, dy) AS sxy FROM r WHERE x IS NOT NULL GROUP BY 1),
    c AS (SELECT series_id, count(*) AS n, var_pop(x) AS sxx, var_pop(l) AS sll, covar_pop(x, l) AS sxl, var_pop(dy) AS syy, covar_pop(x, dy) AS sxy,
      covar_pop(l, dy) AS sly, sxx * sll - sxl * sxl AS det FROM r WHERE l IS NOT NULL GROUP BY 1),
    a AS (SELECT *, syy - sxy * sxy / sxx AS m0, syy - (sxy * sxy * sll - 2 * sxy * sly * sxl + sly * sly * sxx) / det AS m1 FROM c),
    b AS (SELECT *, CAST(n * ln(m1) + 6 < n * ln(m0) + 4 AS INT) AS used FROM a),
    t AS (SELECT b.series_id, used AS used_lags, CASE WHEN used = 1 THEN b.n ELSE f.n END AS n_obs,
      CASE WHEN used = 1 THEN (b.sxy * sll - sly * sxl) / det / sqrt(m1 / (b.n - 3) * sll / det)
        ELSE f.sxy / f.sxx / sqrt((f.syy - f.sxy * f.sxy / f.sxx) / (f.n - 2) / f.sxx) END AS adf_stat FROM b JOIN f USING (series_id))
    FINAL SELECT *, CAST(adf_stat < {TAU} AS INT) AS stationary FROM t""",
)
def stationarity_tests_one_lag(spark, d):
    """The test with at most one lag, which normal equations of two variables reproduce."""
    return unit_root.adf_test(daily(spark, d), BARS, "price", max_lag=1)


@query(
    Shape("series_id scope", "n d sd", ((5, "adf_stat"),)),
    f"""WITH {HALF_OPEN_SQL}, u1 AS (SELECT *, y - lag(y) OVER (PARTITION BY series_id, scope ORDER BY ts) AS y1 FROM scoped),
    u2 AS (SELECT *, y1 - lag(y1) OVER (PARTITION BY series_id, scope ORDER BY ts) AS y2 FROM u1),
    u AS (SELECT series_id, scope, ts, 0 AS d, y AS w FROM u2 UNION ALL SELECT series_id, scope, ts, 1, y1 FROM u2 UNION ALL SELECT series_id, scope, ts, 2, y2 FROM u2),
    v AS (SELECT *, w - lag(w, 7) OVER (PARTITION BY series_id, scope, d ORDER BY ts) AS sw FROM u WHERE w IS NOT NULL),
    x AS (SELECT series_id, scope, d, 0 AS s, ts, w FROM v UNION ALL SELECT series_id, scope, d, 1, ts, sw FROM v WHERE sw IS NOT NULL),
    r AS (SELECT *, lag(w) OVER k AS x, w - lag(w) OVER k AS dw FROM x WINDOW k AS (PARTITION BY series_id, scope, d, s ORDER BY ts)),
    t AS (SELECT series_id, scope, d, s, count(*) AS n_left, regr_slope(dw, x) / sqrt(regr_syy(dw, x) * (1 - regr_r2(dw, x)) / (regr_count(dw, x) - 2) / regr_sxx(dw, x)) AS stat
      FROM r GROUP BY ALL HAVING count(*) >= 8),
    g AS (SELECT series_id, scope, min(d) AS d FROM t WHERE s = 0 AND stat < {TAU} GROUP BY 1, 2),
    n AS (SELECT series_id, scope, count(*) AS n FROM scoped GROUP BY 1, 2 HAVING count(*) >= 8)
    FINAL SELECT n.series_id, n.scope, n, coalesce(g.d, 3) AS d, a.stat AS adf_stat,
      CAST(coalesce(n - g.d - 7 >= 60 AND b.stat < {TAU}, false) AS INT) AS sd
    FROM n LEFT JOIN g USING (series_id, scope) LEFT JOIN t a ON a.series_id = n.series_id AND a.scope = n.scope AND a.d = g.d AND a.s = 0
    LEFT JOIN t b ON b.series_id = n.series_id AND b.scope = n.scope AND b.d = g.d AND b.s = 1""",
)
def differencing_by_regime(spark, d):
    """Both differencing orders of every scope by the test without lags, as if all of them were strongly seasonal."""
    rows = settle(regimed(spark, d))
    every = rows.select("series_id", F.explode(F.array(F.lit("GLOBAL"), F.col("regime"))).alias("scope")).distinct()
    return unit_root.differencing_by_scope(rows, BARS, "price", "regime", every, 7, max_diff=2, max_lag=0)


FITS = [(p, q) for p in (0, 1) for q in (0, 1)]
MEAN_SQUARE = {
    (0, 0): "syy",
    (1, 0): "syy - s1y * s1y / s11",
    (0, 1): "syy - s2y * s2y / s22",
    (1, 1): "syy - (s1y * s1y * s22 - 2 * s1y * s2y * s12 + s2y * s2y * s11) / (s11 * s22 - s12 * s12)",
}
UNION_SQL = " UNION ALL ".join(f"SELECT series_id, scope, {p} AS p, {q} AS q, n, {p + q + 2} AS free, {MEAN_SQUARE[p, q]} AS sigma2 FROM k" for p, q in FITS)


@query(
    Shape("series_id scope model", "p q d n_used", ((3, "aic bic"), (2, "sigma2"))),
    f"""WITH {HALF_OPEN_SQL}, w AS (SELECT series_id, scope, ts, y - lag(y) OVER (PARTITION BY series_id, scope ORDER BY ts) AS w FROM scoped),
    a AS (SELECT *, lag(w) OVER k AS w1, lag(w, 2) OVER k AS w2 FROM w WHERE w IS NOT NULL WINDOW k AS (PARTITION BY series_id, scope ORDER BY ts)),
    m AS (SELECT series_id, scope, count(*) AS rows, avg(w) AS mw, avg(w1) AS m1, avg(w2) AS m2, var_pop(w1) AS s11, var_pop(w2) AS s22, covar_pop(w1, w2) AS s12,
      covar_pop(w1, w) AS s1y, covar_pop(w2, w) AS s2y FROM a WHERE w2 IS NOT NULL GROUP BY 1, 2),
    c AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS a1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS a2 FROM m WHERE rows + 3 >= 19),
    e AS (SELECT a.series_id, a.scope, ts, w, w1, w - mw - a1 * (w1 - m1) - a2 * (w2 - m2) AS e FROM a JOIN c USING (series_id, scope) WHERE w2 IS NOT NULL),
    z AS (SELECT *, lag(e) OVER (PARTITION BY series_id, scope ORDER BY ts) AS e1 FROM e),
    k AS (SELECT series_id, scope, count(*) AS n, var_pop(w) AS syy, var_pop(w1) AS s11, var_pop(e1) AS s22, covar_pop(w1, e1) AS s12, covar_pop(w1, w) AS s1y,
      covar_pop(e1, w) AS s2y FROM z WHERE e1 IS NOT NULL GROUP BY 1, 2), f AS ({UNION_SQL})
    FINAL SELECT series_id, scope, 'ARIMA' AS model, p, q, 1 AS d, n AS n_used, sigma2, n * (ln(2 * pi()) + ln(sigma2) + 1) + 2 * free AS aic,
      n * (ln(2 * pi()) + ln(sigma2) + 1) + free * ln(n) AS bic FROM f""",
)
def moving_average_fits(spark, d):
    """Orders up to (1, 1, 1) of every scope; a first stage of order two has normal equations in SQL."""
    rows = settle(regimed(spark, d))
    scopes = rows.select("series_id", F.explode(F.array(F.lit("GLOBAL"), F.col("regime"))).alias("scope")).distinct()
    hints = scopes.select("*", *[F.lit(v).alias(c) for c, v in (("p", 1), ("q", 1), ("sp", 0), ("sq", 0), ("d", 1), ("sd", 0))])
    return autoregression.search_orders(rows, BARS, "price", hints, regime="regime", long=2)


def hinted(spark, d):
    """Daily prices with regimes, and the orders suggested for each scope."""
    rows = settle(regimed(spark, d))
    strong = strengths(spark, d).where("strong = 1").select("series_id", "scope")
    orders = unit_root.differencing_by_scope(rows, BARS, "price", "regime", strong, 7)
    whole = rows.select("series_id", F.lit("GLOBAL").alias("scope"), "ts", "price")
    parts = rows.select("series_id", F.col("regime").alias("scope"), "ts", "price")
    return rows, correlogram.suggest_orders(whole.unionByName(parts), SCOPED, "price", orders, "1-day", 7)


@query()
def suggested_orders_by_regime(spark, d):
    """All six orders of every scope, from the safe lags of daily series and the seasonal lags."""
    return hinted(spark, d)[1]


@query()
def order_search_by_regime(spark, d):
    """Best five candidates by either criterion for every scope and model; candidates are 0, 1 and the suggestions."""
    rows, hints = hinted(spark, d)
    grid = autoregression.search_orders(rows, BARS, "price", hints, 7, "regime")
    return autoregression.short_list(grid, ["series_id", "scope", "model"]).drop("coef")

"""Naive back-tests, verdicts and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import BARS, DAILY_SQL, PREDICTIONS_SQL, Shape, daily, predictions, query
from driftline.catalog.timejoins import EDGES
from driftline.operators import backtest
from driftline.operators.joins import assign_regime
from driftline.operators.ordered import Series

SCOPED = Series(("series_id", "scope"), "ts")

SCOPES_SQL = f"""{DAILY_SQL}, bounds AS (SELECT min(ts) AS lo, max(ts) AS hi FROM daily),
  marks AS (SELECT lo AS t FROM bounds UNION SELECT hi FROM bounds UNION SELECT unnest({EDGES})::TIMESTAMP),
  cuts AS (SELECT t FROM marks, bounds WHERE t BETWEEN lo AND hi),
  regimes AS (SELECT row_number() OVER (ORDER BY t) AS id, t AS a, lead(t) OVER (ORDER BY t) AS z FROM cuts QUALIFY z IS NOT NULL),
  scoped AS (SELECT series_id, 'GLOBAL' AS scope, ts, price FROM daily UNION ALL
    SELECT series_id, 'REGIME_' || id, ts, price FROM daily, regimes WHERE ts BETWEEN a AND z)"""

EVAL_SQL = f"""{SCOPES_SQL}, n0 AS (SELECT *, row_number() OVER w AS row_no, count(*) OVER (PARTITION BY series_id, scope) AS n,
    lag(price) OVER w AS y_pred FROM scoped WINDOW w AS (PARTITION BY series_id, scope ORDER BY ts)),
  n1 AS (SELECT *, CAST(floor(n * (1.0::DOUBLE - 0.2)) AS BIGINT) AS cut, CAST(floor(n * 0.6::DOUBLE) AS BIGINT) AS least_n FROM n0 WHERE n >= 50),
  n2 AS (SELECT *, (n - least_n) // 4 AS size FROM n1),
  folds AS (SELECT *, 'naive_main' AS name, cut AS train_end, n AS test_end FROM n2 UNION ALL
    SELECT *, 'naive_second_split', cut - (n - cut), cut FROM n2 WHERE n - cut >= 10 AND n >= 2 * (n - cut) + 10 UNION ALL
    SELECT n2.*, 'rolling_fold_' || (i + 1), least_n + i * size, least(least_n + (i + 1) * size, n) FROM n2, range(3) r(i) WHERE n >= 200 AND size >= 10),
  metrics AS (SELECT series_id, scope, name, count(*) FILTER (row_no > train_end) AS n,
    avg(abs(price - y_pred)) FILTER (row_no > train_end) AS mae, sqrt(avg((price - y_pred) * (price - y_pred)) FILTER (row_no > train_end)) AS rmse,
    avg(abs(price - y_pred)) FILTER (row_no > train_end) / nullif(avg(abs(price - y_pred)) FILTER (row_no <= train_end), 0) AS mase,
    100 * avg(2 * abs(price - y_pred) / nullif(abs(price) + abs(y_pred), 0)) FILTER (row_no > train_end) AS smape
    FROM folds WHERE row_no <= test_end AND y_pred IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) FILTER (row_no > train_end) >= 10)"""


def scoped(spark, d):
    """Every series as a whole and cut into regimes whose inner edges belong to both sides."""
    prices = daily(spark, d).select("series_id", "ts", "price")
    regimes = assign_regime(prices, "ts", EDGES, inclusive=True)
    parts = regimes.select("series_id", "ts", "price", F.concat(F.lit("REGIME_"), F.col("regime_id")).alias("scope"))
    return prices.withColumn("scope", F.lit("GLOBAL")).unionByName(parts)


def metrics(spark, d):
    return backtest.evaluate_naive(scoped(spark, d), SCOPED, "price")


METRICS = Shape("series_id scope name", "n", ((3, "mae rmse"), (6, "mase smape")))


@query(METRICS, f"WITH {EVAL_SQL} FINAL SELECT * FROM metrics")
def naive_metrics(spark, d):
    return metrics(spark, d)


@query(METRICS, f"WITH {EVAL_SQL} FINAL SELECT * FROM metrics")
def naive_metrics_split(spark, d):
    series = Series(("series_id", "scope"), "ts", chunk_seconds=200 * 24 * 3600)
    return backtest.evaluate_naive(scoped(spark, d), series, "price", split=True)


@query(
    Shape("series_id ts part", "row_no n_rows split_at"),
    f"""WITH {DAILY_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS row_no, count(*) OVER (PARTITION BY series_id) AS n_rows FROM daily)
    FINAL SELECT *, floor(n_rows * (1.0::DOUBLE - 0.05)) AS split_at, CASE WHEN row_no <= floor(n_rows * (1.0::DOUBLE - 0.05)) THEN 'train' ELSE 'test' END AS part FROM s""",
)
def time_split(spark, d):
    return backtest.time_split(daily(spark, d), BARS, 0.05)


@query(
    Shape("series_id", "n", ((3, "mae rmse"), (6, "mase smape"))),
    f"""WITH {DAILY_SQL}, s AS (SELECT series_id, price AS y, lag(price) OVER (PARTITION BY series_id ORDER BY ts) AS f FROM daily),
    k AS (SELECT * FROM s WHERE f IS NOT NULL) FINAL SELECT series_id, count(*) AS n, avg(abs(y - f)) AS mae, sqrt(avg((y - f) * (y - f))) AS rmse,
    avg(abs(y - f)) / avg(abs(y - f)) AS mase, 100 * avg(2 * abs(y - f) / (abs(y) + abs(f))) AS smape FROM k GROUP BY 1""",
)
def test_scaled_metrics(spark, d):
    naive = backtest.naive_forecast(daily(spark, d), BARS, "price")
    scaled = backtest.test_scaled_metrics(naive, BARS, ["series_id"])
    # the first row has no forecast; the count covers the scored ones
    return scaled.withColumn("n", F.col("n") - 1)


@query(
    Shape("series_id scope", "n_folds", ((6, "mae_cv rmse_cv"),)),
    f"""WITH {EVAL_SQL} FINAL SELECT series_id, scope, count(*) AS n_folds, CASE WHEN count(*) >= 2 THEN stddev_pop(mae) / avg(mae) END AS mae_cv,
    CASE WHEN count(*) >= 2 THEN stddev_pop(rmse) / avg(rmse) END AS rmse_cv FROM metrics WHERE name LIKE 'rolling%' GROUP BY 1, 2""",
)
def fold_variation(spark, d):
    return backtest.cv_of_folds(metrics(spark, d), ["series_id", "scope"])


VERDICT_SQL = f"""{EVAL_SQL}, pair AS (SELECT series_id, scope, {', '.join(
    f"max({m}) FILTER (name = 'naive_main') AS main_{m}, max({m}) FILTER (name = 'naive_second_split') AS second_{m}" for m in ('mae', 'rmse', 'mase'))}
    FROM metrics GROUP BY 1, 2),
  diffs AS (SELECT series_id, scope, {', '.join(f"abs(second_{m} - main_{m}) / nullif(abs(main_{m}), 0) AS {m}_diff" for m in ('mae', 'rmse', 'mase'))} FROM pair),
  cvs AS (SELECT series_id, scope, stddev_pop(mae) / nullif(avg(mae), 0) AS mae_cv, stddev_pop(rmse) / nullif(avg(rmse), 0) AS rmse_cv FROM metrics
    WHERE name LIKE 'rolling%' GROUP BY 1, 2 HAVING count(*) >= 2),
  limits AS (SELECT coalesce((SELECT quantile_cont(x, 0.75) FROM (SELECT unnest([mae_diff, rmse_diff, mase_diff]) AS x FROM diffs)), 0.20) AS stability_threshold,
    coalesce((SELECT quantile_cont(x, 0.75) FROM (SELECT unnest([mae_cv, rmse_cv]) AS x FROM cvs)), 0.30) AS expanding_threshold)"""


@query(Shape("", "", ((6, "stability_threshold expanding_threshold"),)), f"WITH {VERDICT_SQL} FINAL SELECT * FROM limits")
def error_thresholds(spark, d):
    return backtest.p75_thresholds(metrics(spark, d), ["series_id", "scope"])


@query(
    Shape("series_id scope stability_check expanding_check"),
    f"""WITH {VERDICT_SQL} FINAL SELECT m.series_id, m.scope,
    CASE WHEN mae_diff IS NULL OR rmse_diff IS NULL OR mase_diff IS NULL THEN 'insufficient'
      WHEN greatest(mae_diff, rmse_diff, mase_diff) <= stability_threshold THEN 'ok' ELSE 'unstable' END AS stability_check,
    CASE WHEN mae_cv IS NULL OR rmse_cv IS NULL THEN 'insufficient'
      WHEN greatest(mae_cv, rmse_cv) <= expanding_threshold THEN 'ok' ELSE 'unstable' END AS expanding_check
    FROM (SELECT series_id, scope FROM metrics WHERE name = 'naive_main') m LEFT JOIN diffs USING (series_id, scope) LEFT JOIN cvs USING (series_id, scope), limits""",
)
def stability_verdicts(spark, d):
    return backtest.stability_checks(metrics(spark, d), ["series_id", "scope"])


@query(
    Shape("series_id scope name", "", ((3, "mae"), (6, "mase smape"))),
    f"""WITH {EVAL_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mae, scope, name) AS a,
    row_number() OVER (PARTITION BY series_id ORDER BY smape, scope, name) AS b FROM metrics) FINAL SELECT * FROM r WHERE a <= 5 OR b <= 5""",
)
def best_five_by_two_errors(spark, d):
    return backtest.top_n_by(metrics(spark, d), ["series_id"], ["mae", "smape"], 5, ["scope", "name"])


@query(
    Shape("series_id scope name", "", ((3, "mae"), (6, "mase smape"))),
    f"""WITH {EVAL_SQL} FINAL SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, scope ORDER BY mase, smape, mae, name) AS rn
    FROM metrics WHERE name LIKE 'rolling%') WHERE rn = 1""",
)
def best_fold_per_scope(spark, d):
    return backtest.best_model(metrics(spark, d), ["series_id", "scope"], prefix="rolling")


@query(
    Shape("model", "n", ((7, "accuracy precision recall f1 majority_rate auc"),)),
    f"""WITH {PREDICTIONS_SQL}, t AS (SELECT model, proba_up, count(*) FILTER (y_true = 1) AS p, count(*) FILTER (y_true = 0) AS q FROM predictions GROUP BY 1, 2),
    u AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY model ORDER BY proba_up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM t),
    a AS (SELECT model, sum(p * (under + 0.5::DOUBLE * q)) / (sum(p)::DOUBLE * sum(q)::DOUBLE) AS auc FROM u GROUP BY 1),
    b AS (SELECT model, count(*) AS n, avg(CAST(y_true = y_pred AS INT)) AS accuracy, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp,
      count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, greatest(avg(y_true), 1 - avg(y_true)) AS majority_rate FROM predictions GROUP BY 1)
    FINAL SELECT b.*, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, auc FROM b JOIN a USING (model)""",
)
def classification_report(spark, d):
    return backtest.classification_metrics(predictions(spark, d), ["model"])


@query(
    Shape("", "n", ((7, "accuracy precision recall f1 majority_rate"),)),
    """WITH s AS (SELECT quality AS y, CAST(contains(lower(text), 'the') OR contains(lower(text), 'que') AS INT) AS p FROM labels JOIN documents USING (doc_id)),
    b AS (SELECT count(*) AS n, avg(CAST(y = p AS INT)) AS accuracy, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y <> 1 AND p = 1) AS fp,
      count(*) FILTER (y = 1 AND p <> 1) AS fn, greatest(avg(CAST(y = 1 AS INT)), avg(CAST(y <> 1 AS INT))) AS majority_rate FROM s)
    FINAL SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM b""",
)
def document_label_report(spark, d):
    from driftline.functions.text import hits
    from driftline.session import table

    docs = table(spark, d, "documents").select("doc_id", (hits(F.col("text"), ("the", "que")) > 0).cast("int").alias("y_pred"))
    rows = table(spark, d, "labels").join(docs, "doc_id").withColumnRenamed("quality", "y_true")
    return backtest.classification_metrics(rows, [], proba=None)

"""Data-quality and exploration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import (
    AXES, BARS, CANDLES_SQL, DAILY_SQL, NEWS_SQL, PRICES_SQL, TICKS, Shape, candles, daily, events, news, prices, query,
)
from driftline.catalog.features import wide_sql
from driftline.operators import buckets, quality, rolling
from driftline.operators.clean import numeric_columns
from driftline.operators.ordered import Series
from driftline.session import table

WIDE_COLS = [f"sentiment_{s}_{a}" for a in AXES for s in ("mean", "count", "std")] + ["sentiment_total_mean", "total_count"]


def wide(spark, d):
    return buckets.sentiment_null_policy(buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", "1 hour", AXES))


@query(
    Shape("column_name", "", ((7, "ratio"),)),
    f"""WITH {NEWS_SQL}, {wide_sql('series_id', '1 hour')} FINAL SELECT * FROM (
    {' UNION ALL '.join(f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INT)) AS ratio FROM wide" for c in ['series_id', 'bucket', *WIDE_COLS])})
    """,
)
def null_ratios(spark, d):
    return quality.null_ratio(wide(spark, d), None)


@query(
    Shape("column_name", "", ((7, "ratio"),)),
    f"""WITH {NEWS_SQL}, {wide_sql('series_id', '1 hour')} FINAL
    {' UNION ALL '.join(f"SELECT '{c}' AS column_name, avg(coalesce(CAST({c} = 0 AS INT), 0)) AS ratio FROM wide" for c in WIDE_COLS)}""",
)
def zero_ratios(spark, d):
    return quality.zero_ratio(wide(spark, d), None)


@query(
    Shape("", "quality n", ((7, "share"),)),
    "FINAL SELECT quality, count(*) AS n, count(*) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY 1",
)
def class_balance(spark, d):
    return quality.class_balance(table(spark, d, "labels"), "quality")


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    Shape("l_returnflag column_name", "count", ((5, "mean std min p25 p50 p75 max"),)),
    "FINAL " + " UNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
        quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max
        FROM lineitem GROUP BY 1"""
        for c in DESCRIBED
    ),
)
def described_lineitem(spark, d):
    return quality.describe(table(spark, d, "lineitem"), ["l_returnflag"], DESCRIBED)


@query(
    Shape("event_type", "n", ((6, "p01 p50 p99"),)),
    """FINAL SELECT event_type, count(value) AS n, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.99) AS p99
    FROM events GROUP BY 1""",
)
def exact_quantiles_bracketed(spark, d):
    """Exact quantiles through sketch brackets, with a coarse sketch so that the brackets come into play."""
    from driftline.operators.quantiles import exact_quantiles

    q = exact_quantiles(events(spark, d), ["event_type"], "value", [0.01, 0.5, 0.99], accuracy=200)
    return q.select("event_type", "n", F.col("q")[0].alias("p01"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p99"))


TARGET_SQL = f"""{CANDLES_SQL}, tt AS (SELECT *, lead(close) OVER w / nullif(close, 0) - 1 AS future_return,
  CAST(lead(close) OVER w / nullif(close, 0) - 1 > 0 AS INT) AS target_up, close - open AS body, high - low AS span
  FROM candles WINDOW w AS (PARTITION BY series_id ORDER BY ts))"""


def targets(spark, d):
    t = rolling.future_target(candles(spark, d), BARS, "close", 1)
    return t.withColumns({"body": F.col("close") - F.col("open"), "span": F.col("high") - F.col("low")})


@query(
    Shape("target column_name", "rank", ((6, "r"),)),
    f"""WITH {TARGET_SQL}, c AS ({' UNION ALL '.join(
        f"SELECT '{t}' AS target, '{c}' AS column_name, corr({c}, {t}) AS r FROM tt" for t in ('future_return', 'target_up') for c in ('open', 'close', 'body', 'span'))})
    FINAL SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs(r) DESC, column_name) AS rank FROM c)""",
)
def correlation_with_target(spark, d):
    return quality.corr_with_target(targets(spark, d), ["future_return", "target_up"], ["open", "close", "body", "span"], top=None)


@query(
    Shape("", "bin count", ((6, "lo hi"), (5, "mean_return up_rate"))),
    f"""WITH {TARGET_SQL}, known AS (SELECT * FROM tt WHERE body IS NOT NULL AND future_return IS NOT NULL AND target_up IS NOT NULL),
    e AS (SELECT list_sort(list_distinct(quantile_cont(body, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM known),
    b AS (SELECT known.*, e.e, greatest(1, len(list_filter(e.e, lambda x: x < body))) AS bin FROM known, e)
    FINAL SELECT bin, e[bin] AS lo, e[bin + 1] AS hi, count(*) AS count, avg(future_return) AS mean_return, avg(target_up) AS up_rate FROM b GROUP BY 1, 2, 3""",
)
def conditional_returns(spark, d):
    return quality.conditional_analysis(targets(spark, d), "body", 5)


@query(
    Shape("", "bin n", ((6, "lo hi"),)),
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(50, CAST(floor((value - lo) * 50 / (hi - lo)) AS BIGINT) + 1) AS bin, count(*) AS n FROM events, s GROUP BY 1),
    g AS (SELECT unnest(generate_series(1, 50)) AS bin, lo, (hi - lo) / 50 AS w FROM s)
    FINAL SELECT g.bin, lo + (g.bin - 1) * w AS lo, lo + g.bin * w AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (bin)""",
)
def value_histogram(spark, d):
    return quality.histogram(events(spark, d), "value", 50)


CADENCE_SQL = """steps AS (SELECT series_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY series_id ORDER BY ts)) / 1e6 AS delta_s FROM {src}),
  per AS (SELECT series_id, delta_s, count(*) AS n FROM steps WHERE delta_s IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT series_id, arg_min(delta_s, struct_pack(a := -n, b := delta_s)) AS mode_s, min(delta_s) AS min_s, sum(n) AS n_steps, max(n) AS n_mode FROM per GROUP BY 1),
  g AS (SELECT m.*, coalesce((SELECT sum(n) FROM per WHERE per.series_id = m.series_id AND delta_s > mode_s), 0) AS n_gaps,
    (SELECT max(delta_s) FROM per WHERE per.series_id = m.series_id AND delta_s > mode_s) AS max_gap_s, n_mode / n_steps AS share FROM m)"""
CADENCE = Shape("series_id granularity freq verdict", "n_gaps", ((3, "mode_s min_s max_gap_s"), (7, "mode_share irregularity")))
CADENCE_OUT = """FINAL SELECT *, share AS mode_share, 1 - share AS irregularity,
  CASE WHEN mode_s BETWEEN 3500 AND 3700 THEN '1-hour' WHEN mode_s BETWEEN 12600 AND 16200 THEN '4-hour' WHEN mode_s BETWEEN 82800 AND 90000 THEN '1-day' ELSE 'other' END AS granularity,
  CASE WHEN mode_s BETWEEN 3500 AND 3700 THEN '1 hour' WHEN mode_s BETWEEN 12600 AND 16200 THEN '4 hours' WHEN mode_s BETWEEN 82800 AND 90000 THEN '1 day' END AS freq,
  CASE WHEN share >= 0.7 THEN 'regular' ELSE 'irregular' END AS verdict FROM g"""


@query(CADENCE, f"WITH {CANDLES_SQL}, {CADENCE_SQL.format(src='candles')} {CADENCE_OUT}")
def candle_cadence(spark, d):
    return quality.cadence_report(candles(spark, d), BARS)


@query(CADENCE, f"WITH {DAILY_SQL}, {CADENCE_SQL.format(src='daily')} {CADENCE_OUT}")
def daily_cadence(spark, d):
    return quality.cadence_report(daily(spark, d), BARS)


@query(
    Shape("series_id ts", "", ((6, "delta_s"),)),
    f"""WITH {PRICES_SQL}, s AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY series_id ORDER BY ts, event_id)) / 1e6 AS delta_s FROM prices)
    FINAL SELECT * FROM s WHERE delta_s > 3600 ORDER BY delta_s DESC, series_id, ts LIMIT 20""",
)
def longest_gaps(spark, d):
    return quality.gap_sample(prices(spark, d), TICKS, 3600, 20)


@query(
    Shape("event_type", "n_rows n_backward"),
    """WITH s AS (SELECT event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS p FROM events)
    FINAL SELECT event_type, count(*) AS n_rows, count(*) FILTER (value < p) AS n_backward FROM s GROUP BY 1""",
)
def monotonic_values(spark, d):
    """Arrival order against another column; the tables' times rise with the id, so the value shows backward steps."""
    arrival = Series(("event_type",), "event_id")
    return quality.monotonic_check(events(spark, d), arrival, "value")


@query(
    Shape("event_type ts", "event_id"),
    """FINAL SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 100""",
)
def last_rows_per_series(spark, d):
    from driftline.operators.backtest import tail_n

    return tail_n(prices(spark, d).withColumnRenamed("series_id", "event_type"), Series(("event_type",), "ts", ("event_id",)), 100)


@query(
    Shape("column_name", "", ((6, "mean"),)),
    "FINAL " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg({c}) AS mean FROM customer" for c in ("c_custkey", "c_nationkey", "c_acctbal")),
)
def numeric_column_means(spark, d):
    """Means of whatever columns are numeric, found from the schema."""
    customer = table(spark, d, "customer")
    cols = numeric_columns(customer)
    return customer.agg(*[F.avg(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "mean")

"""Sentiment and price features."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import (
    AXES, BARS, CANDLES_SQL, DAILY_SQL, INDEX_SQL, NEWS_SQL, PRICES_SQL, TICKS, Shape, candles, daily, daily_index,
    events, news, prices, query,
)
from driftline.operators import buckets, rolling
from driftline.operators.joins import fill_from_index
from driftline.operators.ordered import Series
from driftline.plans.price import PROFILES, features_at, price_features
from driftline.plans.sentiment import sentiment_features

MEANS = [f"sentiment_mean_{a}" for a in AXES] + ["sentiment_total_mean"]


def wide_sql(keys: str, freq: str) -> str:
    parts = ", ".join(
        f"""coalesce(avg(sentiment_score) FILTER (axis = '{a}'), 0) AS sentiment_mean_{a},
        nullif(count(sentiment_score) FILTER (axis = '{a}'), 0) AS sentiment_count_{a},
        stddev_samp(sentiment_score) FILTER (axis = '{a}') AS sentiment_std_{a}"""
        for a in AXES
    )
    return f"""wide AS (SELECT {keys}, time_bucket(INTERVAL '{freq}', published_at) AS bucket, {parts},
      coalesce(avg(sentiment_score), 0) AS sentiment_total_mean, nullif(count(sentiment_score), 0) AS total_count
      FROM news GROUP BY 1, 2 HAVING count(axis) > 0)"""


def rolled_sql(keys: str) -> str:
    cols = []
    for c in MEANS:
        cols.append(
            f"""CASE WHEN count({c}) OVER p >= 3 THEN avg({c}) OVER p END AS {c}_roll_mean,
            CASE WHEN count({c}) OVER p >= 3 THEN stddev_samp({c}) OVER p END AS {c}_roll_std,
            {c} - lag({c}) OVER o AS {c}_momentum, lag({c}) OVER o AS {c}_lag1"""
        )
    return f"""rolled AS (SELECT *, {', '.join(cols)} FROM wide
      WINDOW o AS (PARTITION BY {keys} ORDER BY bucket),
             p AS (PARTITION BY {keys} ORDER BY bucket ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


SHOCKS = ", ".join(
    f"""CASE WHEN {c} > {c}_roll_mean + 2.0 * {c}_roll_std THEN 1
        WHEN {c} < {c}_roll_mean - 2.0 * {c}_roll_std THEN -1 ELSE 0 END AS {c}_shock"""
    for c in MEANS
)
WIDE_INTS = " ".join([f"sentiment_count_{a}" for a in AXES] + ["total_count"])
WIDE_REALS = " ".join(MEANS + [f"sentiment_std_{a}" for a in AXES])
ROLL_REALS = " ".join(f"{c}_{s}" for c in MEANS for s in ("roll_mean", "roll_std", "momentum", "lag1"))
SHOCK_INTS = " ".join(f"{c}_shock" for c in MEANS)
FEATURES = Shape(
    "series_id bucket", f"{WIDE_INTS} {SHOCK_INTS}",
    ((7, f"{WIDE_REALS} {ROLL_REALS} div_btc_macro fear_greed_index"), (5, "news_ratio_btc_macro")),
)
EXTRA = """sentiment_mean_BTC - sentiment_mean_MACRO AS div_btc_macro,
  sentiment_count_BTC / (sentiment_count_MACRO + 1e-6) AS news_ratio_btc_macro"""


@query(
    Shape("bucket axis", "sentiment_count", ((7, "sentiment_mean sentiment_std"),)),
    f"""WITH {NEWS_SQL} FINAL SELECT time_bucket(INTERVAL '4 hours', published_at) AS bucket, axis,
    avg(sentiment_score) AS sentiment_mean, count(sentiment_score) AS sentiment_count,
    stddev_samp(sentiment_score) AS sentiment_std FROM news WHERE axis IS NOT NULL GROUP BY 1, 2""",
)
def bucket_axis_agg_4h(spark, d):
    return buckets.bucket_axis_agg(news(spark, d), [], "published_at", "4 hours")


@query(
    Shape("bucket", "total_count", ((7, "sentiment_total_mean"),)),
    f"""WITH {NEWS_SQL} FINAL SELECT time_bucket(INTERVAL '1 hour', published_at) AS bucket,
    avg(sentiment_score) AS sentiment_total_mean, count(sentiment_score) AS total_count FROM news GROUP BY 1""",
)
def bucket_total_1h(spark, d):
    return buckets.bucket_total(news(spark, d), [], "published_at", "1 hour")


@query(
    Shape("series_id bucket", WIDE_INTS, ((7, WIDE_REALS),)),
    f"WITH {NEWS_SQL}, {wide_sql('series_id', '1 hour')} FINAL SELECT * FROM wide",
)
def sentiment_wide_1h(spark, d):
    wide = buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", "1 hour", AXES)
    return buckets.sentiment_null_policy(wide)


@query(
    FEATURES,
    f"""WITH {NEWS_SQL}, {INDEX_SQL}, {wide_sql('series_id', '4 hours')}, {rolled_sql('series_id')} FINAL
    SELECT rolled.*, {SHOCKS}, {EXTRA}, coalesce(last_value(fear_greed_index IGNORE NULLS) OVER (
      PARTITION BY series_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 50) AS fear_greed_index
    FROM rolled LEFT JOIN daily_index ON datetime = bucket""",
)
def sentiment_features_4h(spark, d):
    return sentiment_features(news(spark, d), ["series_id"], freq="4 hours", index=daily_index(spark, d))


@query(
    FEATURES,
    f"""WITH {NEWS_SQL}, {INDEX_SQL}, {wide_sql('series_id', '1 hour')}, {rolled_sql('series_id')} FINAL
    SELECT rolled.*, {SHOCKS}, {EXTRA}, coalesce(fear_greed_index, 50) AS fear_greed_index
    FROM rolled ASOF LEFT JOIN daily_index ON rolled.bucket >= daily_index.datetime""",
)
def sentiment_features_index_asof(spark, d):
    return sentiment_features(news(spark, d), ["series_id"], freq="1 hour", index=daily_index(spark, d), index_mode="asof")


@query(
    Shape("bucket", f"user_id {WIDE_INTS} {SHOCK_INTS}", ((7, f"{WIDE_REALS} {ROLL_REALS} div_btc_macro"), (5, "news_ratio_btc_macro"))),
    f"""WITH {NEWS_SQL}, {wide_sql('user_id', '24 hours')}, {rolled_sql('user_id')} FINAL
    SELECT *, {SHOCKS}, {EXTRA} FROM rolled""",
)
def sentiment_features_daily_by_user(spark, d):
    return sentiment_features(news(spark, d), ["user_id"], freq="24 hours")


@query(
    Shape("bucket", "", ((7, "sentiment_total_mean fear_greed_index"),)),
    f"""WITH {NEWS_SQL}, {INDEX_SQL}, {wide_sql('series_id', '1 hour')} FINAL
    SELECT bucket, sentiment_total_mean, coalesce(last_value(fear_greed_index IGNORE NULLS) OVER (
      ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 50) AS fear_greed_index
    FROM wide LEFT JOIN daily_index ON datetime = bucket""",
)
def index_exact_then_fill_split(spark, d):
    wide = buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", "1 hour", AXES)
    series = Series(("series_id",), "bucket", chunk_seconds=3 * 24 * 3600)
    return fill_from_index(
        buckets.sentiment_null_policy(wide), daily_index(spark, d), series, "datetime", "fear_greed_index", "fear_greed_index", split=True
    )


@query(
    Shape("series_id bucket", "n_points", ((6, "open high low close"),)),
    f"""WITH {PRICES_SQL} FINAL SELECT series_id, time_bucket(INTERVAL '4 hours', ts) AS bucket,
    arg_min(price, struct_pack(a := ts, b := event_id)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, struct_pack(a := ts, b := event_id)) AS close, count(*) AS n_points FROM prices GROUP BY 1, 2""",
)
def ohlc_resample_4h(spark, d):
    return buckets.ohlc_resample(prices(spark, d), ["series_id"], "ts", "price", "4 hours", "event_id")


DENSITY_SQL = """per AS (SELECT {k}, time_bucket(INTERVAL '{f}', ts) AS bucket, count(*) AS n_points FROM events GROUP BY 1, 2),
  density AS (SELECT {k}, date_diff('hour', min(bucket), max(bucket)) // {h} + 1 AS n_slots,
    count(*) FILTER (n_points >= 2) AS n_dense, count(*) FILTER (n_points >= 2) / (date_diff('hour', min(bucket), max(bucket)) // {h} + 1) AS density
    FROM per GROUP BY 1)"""


@query(
    Shape("event_type", "n_slots n_dense", ((7, "density"),)),
    f"WITH {DENSITY_SQL.format(k='event_type', f='1 hour', h=1)} FINAL SELECT * FROM density",
)
def candle_density_1h(spark, d):
    return buckets.candle_density(events(spark, d), ["event_type"], "ts", "value", "1 hour")


@query(
    Shape("bucket mode", "user_id", ((6, "open high low close"),)),
    f"""WITH {DENSITY_SQL.format(k='user_id', f='1 day', h=24)},
    bars AS (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS bucket,
      arg_min(value, struct_pack(a := ts, b := event_id)) AS open, max(value) AS high, min(value) AS low,
      arg_max(value, struct_pack(a := ts, b := event_id)) AS close FROM events GROUP BY 1, 2)
    FINAL SELECT bars.*, 'computed_ohlc' AS mode FROM bars JOIN density USING (user_id) WHERE density >= 0.6
    UNION ALL SELECT user_id, NULL, NULL, NULL, NULL, NULL, 'line' FROM density WHERE density < 0.6""",
)
def build_ohlc_by_user(spark, d):
    points = events(spark, d).select("user_id", "ts", "event_id", F.col("value").alias("price"))
    return buckets.build_ohlc(points, ["user_id"], "ts", "1 day", tie="event_id")


def price_sql(p, source: str) -> str:
    def upto(n):
        return f"(PARTITION BY series_id ORDER BY {source}_order ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    o = f"(PARTITION BY series_id ORDER BY {source}_order)"
    moves = [f"close / nullif(lag(close, {n}) OVER {o}, 0) - 1 AS ret_{n}" for n in p.returns]
    moves += [f"lag(close, {n}) OVER {o} AS close_lag_{n}" for n in p.lags]
    moves.append(
        f"CASE WHEN count(close) OVER {upto(p.sma)} >= {p.sma} THEN close / nullif(avg(close) OVER {upto(p.sma)}, 0) - 1 END AS mom_sma{p.sma}"
    )
    stds = [f"CASE WHEN count(ret_1) OVER {upto(n)} >= {n} THEN stddev_samp(ret_1) OVER {upto(n)} END AS std_{n}" for n in p.stds]
    text = f"""moves AS (SELECT *, {', '.join(moves)} FROM {source}),
      feats AS (SELECT *, {', '.join(stds)}, (high - low) / nullif(close, 0) AS range_norm,
        (isodow(ts) - 1) AS dayofweek, hour(ts) AS hour FROM moves)"""
    return text.replace(f"{source}_order", "ts, event_id" if source == "ticks" else "ts")


def price_shape(p) -> Shape:
    ints = "dayofweek" + (" hour" if p.hour else "")
    reals = " ".join(c for c in p.columns if c not in ("dayofweek", "hour"))
    return Shape("series_id ts", ints, ((4, reals), (6, "open high low close")))


@query(price_shape(PROFILES["1h"]), f"WITH {CANDLES_SQL}, {price_sql(PROFILES['1h'], 'candles')} FINAL SELECT * FROM feats")
def price_features_1h(spark, d):
    return price_features(candles(spark, d), BARS, "1h")


@query(price_shape(PROFILES["24h"]), f"WITH {DAILY_SQL}, {price_sql(PROFILES['24h'], 'daily')} FINAL SELECT * FROM feats")
def price_features_24h(spark, d):
    return price_features(daily(spark, d), BARS, "24h")


TICKS_SQL = PRICES_SQL + ", ticks AS (SELECT *, price AS open, price AS high, price AS low, price AS close FROM prices)"


@query(price_shape(PROFILES["1h"]), f"WITH {TICKS_SQL}, {price_sql(PROFILES['1h'], 'ticks')} FINAL SELECT * FROM feats")
def price_features_ticks_split(spark, d):
    """Every event is a candle; series are cut into chunks with copied edge rows."""
    p = F.col("price")
    ticks = prices(spark, d).withColumns({"open": p, "high": p, "low": p, "close": p})
    series = Series(("series_id",), "ts", ("event_id",), chunk_seconds=3 * 24 * 3600)
    return price_features(ticks, series, "1h", split=True, rows_per_chunk=2000)


@query(
    Shape("t series_id", "event_id", ((6, "delta_s"), (4, "ret_1 mom_sma24 std_24"))),
    f"""WITH {CANDLES_SQL}, {price_sql(PROFILES['1h'], 'candles')},
    ready AS (SELECT * FROM feats WHERE ret_24 IS NOT NULL AND std_24 IS NOT NULL AND mom_sma24 IS NOT NULL AND ret_1 IS NOT NULL
      AND ret_2 IS NOT NULL AND ret_4 IS NOT NULL AND ret_8 IS NOT NULL AND std_8 IS NOT NULL AND range_norm IS NOT NULL),
    targets AS (SELECT event_id, event_type AS series_id, ts AS t FROM events),
    b AS (SELECT event_id, r.* FROM targets ASOF JOIN ready r ON targets.series_id = r.series_id AND targets.t >= r.ts),
    f AS (SELECT event_id, r.* FROM targets ASOF JOIN ready r ON targets.series_id = r.series_id AND targets.t <= r.ts),
    pick AS (SELECT targets.*, CASE WHEN b.ts IS NULL OR epoch_us(f.ts) - epoch_us(t) <= epoch_us(t) - epoch_us(b.ts) THEN f ELSE b END AS m
      FROM targets LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id))
    FINAL SELECT t, series_id, event_id,
      CASE WHEN abs(epoch_us(m.ts) - epoch_us(t)) <= 3600000000 THEN abs(epoch_us(m.ts) - epoch_us(t)) / 1e6 END AS delta_s,
      CASE WHEN abs(epoch_us(m.ts) - epoch_us(t)) <= 3600000000 THEN m.ret_1 END AS ret_1,
      CASE WHEN abs(epoch_us(m.ts) - epoch_us(t)) <= 3600000000 THEN m.mom_sma24 END AS mom_sma24,
      CASE WHEN abs(epoch_us(m.ts) - epoch_us(t)) <= 3600000000 THEN m.std_24 END AS std_24 FROM pick""",
)
def price_features_near_target(spark, d):
    targets = events(spark, d).select("event_id", F.col("event_type").alias("series_id"), F.col("ts").alias("t"))
    return features_at(targets, candles(spark, d), BARS, "t", "1h")


@query(
    Shape("series_id ts", "event_id", ((6, "ma"),)),
    f"""WITH {PRICES_SQL} FINAL SELECT series_id, ts, event_id, avg(price) OVER (PARTITION BY series_id ORDER BY ts, event_id
      ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS ma FROM prices""",
)
def moving_average_24(spark, d):
    return rolling.moving_average(prices(spark, d), TICKS, "price", 24)


@query(
    Shape("series_id ts", "event_id", ((6, "price price_lag_1 price_lag_2 price_lag_4"),)),
    f"""WITH {PRICES_SQL} FINAL SELECT *, lag(price, 1) OVER w AS price_lag_1, lag(price, 2) OVER w AS price_lag_2,
      lag(price, 4) OVER w AS price_lag_4 FROM prices WINDOW w AS (PARTITION BY series_id ORDER BY ts, event_id)""",
)
def lagged_prices(spark, d):
    return rolling.lag_columns(prices(spark, d), TICKS, "price", [1, 2, 4])


@query(
    Shape("series_id ts", "event_id", ((5, "ret"),)),
    f"""WITH {PRICES_SQL}, r AS (SELECT *, ln(nullif(price, 0)) - lag(ln(nullif(price, 0))) OVER (PARTITION BY series_id ORDER BY ts, event_id) AS ret FROM prices),
    q AS (SELECT series_id, count(ret) AS n, quantile_cont(ret, 0.01) AS lo, quantile_cont(ret, 0.99) AS hi FROM r WHERE ret IS NOT NULL GROUP BY 1)
    FINAL SELECT series_id, ts, event_id, CASE WHEN n > 50 THEN greatest(lo, least(hi, ret)) ELSE ret END AS ret
    FROM r JOIN q USING (series_id) WHERE ret IS NOT NULL""",
)
def log_returns_clipped(spark, d):
    got = rolling.returns(prices(spark, d), TICKS, "price", "log")
    return rolling.quantile_clip(got, ["series_id"], "ret")


@query(
    Shape("series_id ts", "", ((4, "diff"),)),
    f"""WITH {DAILY_SQL}, a AS (SELECT *, price - lag(price) OVER (PARTITION BY series_id ORDER BY ts) AS x FROM daily),
    b AS (SELECT *, x - lag(x) OVER (PARTITION BY series_id ORDER BY ts) AS y FROM a),
    c AS (SELECT *, y - lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS diff FROM b)
    FINAL SELECT * FROM c WHERE diff IS NOT NULL""",
)
def differenced_twice_and_weekly(spark, d):
    return rolling.difference(daily(spark, d), BARS, "price", d=2, seasonal=1, period=7)


@query(
    Shape("series_id ts", "target_up", ((4, "future_return"),)),
    f"""WITH {CANDLES_SQL} FINAL SELECT series_id, ts, lead(close, 4) OVER w / nullif(close, 0) - 1 AS future_return,
      CAST(lead(close, 4) OVER w / nullif(close, 0) - 1 > 0 AS INT) AS target_up FROM candles
      WINDOW w AS (PARTITION BY series_id ORDER BY ts)""",
)
def future_target_4(spark, d):
    return rolling.future_target(candles(spark, d), BARS, "close", 4)


@query(
    Shape("series_id ts", "target_up total_count", ((7, "sentiment_total_mean"), (4, "future_return"))),
    f"""WITH {NEWS_SQL}, {wide_sql('series_id', '1 hour')}, {CANDLES_SQL},
    t AS (SELECT series_id, ts, lead(close) OVER w / nullif(close, 0) - 1 AS future_return,
      CAST(lead(close) OVER w / nullif(close, 0) - 1 > 0 AS INT) AS target_up FROM candles
      WINDOW w AS (PARTITION BY series_id ORDER BY ts))
    FINAL SELECT t.*, total_count, sentiment_total_mean FROM t JOIN wide ON t.ts = wide.bucket""",
)
def features_with_target(spark, d):
    wide = buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", "1 hour", AXES).drop("series_id")
    target = rolling.future_target(candles(spark, d), BARS, "close", 1)
    return target.join(buckets.sentiment_null_policy(wide).withColumnRenamed("bucket", "ts"), "ts")

"""Joins in time and model merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import (
    CANDLES_SQL, PREDICTIONS_SQL, Shape, candles, events, predictions, prices, query,
)
from driftline.operators import joins
from driftline.session import table

PAIRS_SQL = """l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
  r AS (SELECT user_id, ts, event_id AS view_id, value FROM events WHERE event_type = 'view'),
  back AS (SELECT l.event_id, r.ts, r.view_id, r.value FROM l ASOF JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts),
  fwd AS (SELECT l.event_id, r.ts, r.view_id, r.value FROM l ASOF JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts),
  gaps AS (SELECT l.*, back.ts AS bts, back.view_id AS bid, back.value AS bval, fwd.ts AS fts, fwd.view_id AS fid, fwd.value AS fval,
    (epoch_us(l.ts) - epoch_us(back.ts)) / 1e6 AS bgap, (epoch_us(fwd.ts) - epoch_us(l.ts)) / 1e6 AS fgap
    FROM l LEFT JOIN back USING (event_id) LEFT JOIN fwd USING (event_id))"""
PAIR = Shape("ts r_ts", "event_id user_id r_view_id", ((6, "r_value delta_s"),))


def pick(later: str) -> str:
    use = f"bts IS NULL OR {later}"
    return f"""SELECT event_id, user_id, ts, CASE WHEN {use} THEN fts ELSE bts END AS r_ts,
      CASE WHEN {use} THEN fid ELSE bid END AS r_view_id, CASE WHEN {use} THEN fval ELSE bval END AS r_value,
      CASE WHEN {use} THEN fgap ELSE bgap END AS delta_s FROM gaps"""


def pair(spark, d):
    e = events(spark, d)
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), "value")
    return left, right


def nearest(spark, d, **kw):
    left, right = pair(spark, d)
    return joins.asof_join(left, right, ["user_id"], "ts", "ts", ["view_id", "value"], right_tie=["view_id"], **kw)


@query(PAIR, f"WITH {PAIRS_SQL} FINAL {pick('fgap <= bgap')}")
def asof_nearest_later(spark, d):
    return nearest(spark, d)


@query(PAIR, f"WITH {PAIRS_SQL} FINAL {pick('fgap < bgap')}")
def asof_nearest_earlier(spark, d):
    return nearest(spark, d, tie="earlier")


@query(PAIR, f"WITH {PAIRS_SQL} FINAL {pick('fgap <= bgap')}")
def asof_nearest_split(spark, d):
    """Hot keys cut into time chunks of at most a few hundred rows."""
    return nearest(spark, d, split=True, rows_per_chunk=500, chunk_seconds=2 * 24 * 3600)


@query(PAIR, f"WITH {PAIRS_SQL} FINAL SELECT event_id, user_id, ts, bts AS r_ts, bid AS r_view_id, bval AS r_value, bgap AS delta_s FROM gaps")
def asof_backward(spark, d):
    return nearest(spark, d, direction="backward")


@query(PAIR, f"WITH {PAIRS_SQL} FINAL SELECT event_id, user_id, ts, fts AS r_ts, fid AS r_view_id, fval AS r_value, fgap AS delta_s FROM gaps")
def asof_forward(spark, d):
    return nearest(spark, d, direction="forward")


@query(
    PAIR,
    f"""WITH {PAIRS_SQL}, picked AS ({pick('fgap <= bgap')}) FINAL SELECT event_id, user_id, ts,
    CASE WHEN delta_s <= 14400 THEN r_ts END AS r_ts, CASE WHEN delta_s <= 14400 THEN r_view_id END AS r_view_id,
    CASE WHEN delta_s <= 14400 THEN r_value END AS r_value, CASE WHEN delta_s <= 14400 THEN delta_s END AS delta_s FROM picked""",
)
def asof_within_tolerance(spark, d):
    return nearest(spark, d, tolerance_s=4 * 3600)


@query(
    Shape("t r_ts", "event_id exact", ((6, "r_close delta_s"),)),
    f"""WITH {CANDLES_SQL}, l AS (SELECT event_id, event_type AS series_id, date_trunc('minute', ts) AS t FROM events),
    back AS (SELECT l.event_id, c.ts, c.close FROM l ASOF JOIN candles c ON l.series_id = c.series_id AND l.t >= c.ts),
    fwd AS (SELECT l.event_id, c.ts, c.close FROM l ASOF JOIN candles c ON l.series_id = c.series_id AND l.t <= c.ts),
    g AS (SELECT l.*, back.ts AS bts, back.close AS bval, fwd.ts AS fts, fwd.close AS fval,
      epoch_us(t) - epoch_us(back.ts) AS bgap, epoch_us(fwd.ts) - epoch_us(t) AS fgap
      FROM l LEFT JOIN back USING (event_id) LEFT JOIN fwd USING (event_id))
    FINAL SELECT event_id, t, CASE WHEN bts IS NULL OR fgap < bgap THEN fts ELSE bts END AS r_ts,
      CASE WHEN bts IS NULL OR fgap < bgap THEN fval ELSE bval END AS r_close,
      CASE WHEN bts IS NULL OR fgap < bgap THEN fgap ELSE bgap END / 1e6 AS delta_s,
      CAST(CASE WHEN bts IS NULL OR fgap < bgap THEN fgap ELSE bgap END = 0 AS INT) AS exact FROM g""",
)
def exact_else_nearest(spark, d):
    targets = events(spark, d).select(
        "event_id", F.col("event_type").alias("series_id"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("t")
    )
    return joins.exact_else_nearest(targets, candles(spark, d), ["series_id"], "t", "ts", ["close"])


@query(
    Shape("series_id target", "event_id", ((6, "base_price"),)),
    f"""WITH {CANDLES_SQL}, targets AS (SELECT event_id, event_type AS series_id, date_trunc('hour', ts) AS target FROM events),
    e AS (SELECT t.*, c.close AS exact FROM targets t LEFT JOIN candles c ON c.series_id = t.series_id AND c.ts = t.target - INTERVAL 4 HOUR),
    b AS (SELECT e.*, c.close AS prev FROM e ASOF LEFT JOIN candles c ON e.series_id = c.series_id AND e.target >= c.ts),
    p AS (SELECT b.*, k.price AS known FROM b ASOF LEFT JOIN (SELECT series_id, ts, arg_max(price, event_id) AS price FROM prices GROUP BY 1, 2) k
      ON b.series_id = k.series_id AND b.target >= k.ts)
    FINAL SELECT event_id, series_id, target, coalesce(exact, prev, known) AS base_price FROM p""",
)
def base_price_4h(spark, d):
    targets = events(spark, d).select(
        "event_id", F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("target")
    )
    return joins.base_price(targets, candles(spark, d), prices(spark, d), ["series_id"], "target", 4)


EDGES = ["1990-01-01", "1996-07-09", "1998-05-11", "2000-04-20", "2005-01-01"]
REGIME_SQL = """bounds AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
  marks AS (SELECT lo AS t FROM bounds UNION SELECT hi FROM bounds UNION
    SELECT unnest(['1990-01-01', '1996-07-09', '1998-05-11', '2000-04-20', '2005-01-01'])::TIMESTAMP),
  cuts AS (SELECT t FROM marks, bounds WHERE t BETWEEN lo AND hi),
  regimes AS (SELECT row_number() OVER (ORDER BY t) AS regime_id, t AS regime_start, lead(t) OVER (ORDER BY t) AS regime_end FROM cuts
    QUALIFY regime_end IS NOT NULL)"""
REGIME = Shape("o_orderdate regime_start regime_end", "o_orderkey regime_id")


def orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")


@query(REGIME, f"""WITH {REGIME_SQL} FINAL SELECT * FROM orders JOIN regimes, bounds
    WHERE o_orderdate >= regime_start AND (o_orderdate < regime_end OR (o_orderdate = hi AND regime_end = hi))""".replace("JOIN regimes, bounds", ", regimes, bounds"))
def regimes_half_open(spark, d):
    return joins.assign_regime(orders(spark, d), "o_orderdate", EDGES)


@query(REGIME, f"WITH {REGIME_SQL} FINAL SELECT * FROM orders, regimes WHERE o_orderdate BETWEEN regime_start AND regime_end")
def regimes_inclusive(spark, d):
    return joins.assign_regime(orders(spark, d), "o_orderdate", EDGES, inclusive=True)


MERGED_SQL = f"""{PREDICTIONS_SQL}, a AS (SELECT * FROM predictions WHERE model = 'rf'), b AS (SELECT * FROM predictions WHERE model = 'gbt'),
  merged AS (SELECT event_id, datetime, a.y_pred AS y_pred_rf, b.y_pred AS y_pred_gbt, coalesce(a.y_true, b.y_true) AS y_true
    FROM a FULL JOIN b USING (event_id, datetime))"""


def merged(spark, d):
    p = predictions(spark, d)
    return joins.merge_models(p.where("model = 'rf'"), p.where("model = 'gbt'"), ["event_id", "datetime"], "rf", "gbt")


@query(Shape("datetime", "event_id y_pred_rf y_pred_gbt y_true"), f"WITH {MERGED_SQL} FINAL SELECT * FROM merged")
def merged_models(spark, d):
    return merged(spark, d)


@query(
    Shape("datetime", "event_id y_pred_rf y_pred_gbt agree"),
    f"""WITH {MERGED_SQL} FINAL SELECT *, CAST(y_pred_rf = y_pred_gbt AS INT) AS agree FROM merged
    WHERE y_pred_rf IS NOT NULL AND y_pred_gbt IS NOT NULL""",
)
def model_agreement(spark, d):
    return joins.agreement(merged(spark, d), "y_pred_rf", "y_pred_gbt")


@query(
    Shape("datetime", "event_id y_true y_pred"),
    f"""WITH {PREDICTIONS_SQL} FINAL SELECT p.event_id, p.datetime, e.user_id % 3 AS y_true, p.y_pred
    FROM predictions p JOIN events e ON p.event_id = e.event_id WHERE p.model = 'rf'""",
)
def aligned_pairs(spark, d):
    actual = events(spark, d).select("event_id", (F.col("user_id") % 3).alias("y_true"))
    forecast = predictions(spark, d).where("model = 'rf'").drop("y_true", "model")
    return joins.aligned_pairs(actual, forecast, ["event_id"])

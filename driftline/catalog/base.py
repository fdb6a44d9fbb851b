"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.ordered import Series
from driftline.session import prepare, table


def nudge(digits: int) -> str:
    return f"3.1e-{digits + 2}"


@dataclass(frozen=True)
class Shape:
    """Output columns: plain ones, whole numbers, and decimals by number of digits. Applied alike on both sides.

    Decimals are nudged by a thirtieth of the last digit before rounding, so that a value exactly between two
    roundings does not hang on the last bit of a sum.
    """

    plain: str = ""
    ints: str = ""
    digits: tuple[tuple[int, str], ...] = ()

    def frame(self, df: DataFrame) -> DataFrame:
        cols = [F.col(c) for c in self.plain.split()]
        cols += [F.col(c).cast("bigint").alias(c) for c in self.ints.split()]
        cols += [
            (F.round(F.col(c).cast("double") + F.lit(float(nudge(d))), d) + 0.0).alias(c)  # + 0.0 unsigns a zero
            for d, names in self.digits
            for c in names.split()
        ]
        return df.select(*cols)

    def sql(self, inner: str) -> str:
        cols = self.plain.split()
        cols += [f"CAST({c} AS BIGINT) AS {c}" for c in self.ints.split()]
        cols += [f"ROUND(CAST({c} AS DOUBLE) + {nudge(d)}::DOUBLE, {d}) + 0.0 AS {c}" for d, names in self.digits for c in names.split()]
        head, tail = re.split(r"\bFINAL\s", inner)
        return f"{head}SELECT {', '.join(cols)} FROM ({tail})"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(shape: Shape | None = None, sql: str | None = None, name: str | None = None):
    """Register a function of (spark, folder). In ``sql`` the word FINAL marks the start of the last SELECT."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = fn(prepare(spark), folder)
            return shape.frame(out) if shape else out

        CATALOG[name or fn.__name__] = Query(run, shape.sql(sql) if shape and sql else sql)
        return fn

    return register


# ---- roles of the tables: the same mapping as columns and as SQL ----

AXIS_OF = {"purchase": "BTC", "click": "MACRO", "view": "TECH"}
AXES = ("BTC", "MACRO", "TECH")

NEWS_SQL = """news AS (
  SELECT event_id, user_id, ts AS published_at, 'market' AS series_id,
         CASE event_type WHEN 'purchase' THEN 'BTC' WHEN 'click' THEN 'MACRO' WHEN 'view' THEN 'TECH' END AS axis,
         greatest(-1.0, least(1.0, (value - 50) / 100)) AS sentiment_score
  FROM events)"""
PRICES_SQL = "prices AS (SELECT event_type AS series_id, ts, event_id, value AS price FROM events)"
INDEX_SQL = """daily_index AS (
  SELECT date_trunc('day', ts) AS datetime, floor(avg(value)) AS fear_greed_index FROM events GROUP BY 1)"""
CANDLES_SQL = (
    PRICES_SQL
    + """, candles AS (
  SELECT series_id, time_bucket(INTERVAL '1 hour', ts) AS ts,
         arg_min(price, struct_pack(a := ts, b := event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, struct_pack(a := ts, b := event_id)) AS close
  FROM prices GROUP BY 1, 2)"""
)
DAILY_SQL = """daily AS (
  SELECT c_mktsegment AS series_id, o_orderdate AS ts,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, avg(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Scored articles: one per event."""
    axis = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in AXIS_OF.items()])
    score = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("value") - 50) / 100))
    return events(spark, folder).select(
        "event_id",
        "user_id",
        F.col("ts").alias("published_at"),
        F.lit("market").alias("series_id"),
        axis.alias("axis"),
        score.alias("sentiment_score"),
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Price points: the event type is the series."""
    return events(spark, folder).select(
        F.col("event_type").alias("series_id"), "ts", "event_id", F.col("value").alias("price")
    )


def daily_index(spark: SparkSession, folder: str) -> DataFrame:
    return (
        events(spark, folder)
        .groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("datetime"))
        .agg(F.floor(F.avg("value")).alias("fear_greed_index"))
    )


def candles(spark: SparkSession, folder: str) -> DataFrame:
    from driftline.operators.buckets import ohlc_resample

    return ohlc_resample(prices(spark, folder), ["series_id"], "ts", "price", "1 hour", "event_id").withColumnRenamed(
        "bucket", "ts"
    )


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily candles and mean price per market segment."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("series_id"), F.col("o_orderdate").alias("ts"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.avg("o_totalprice").alias("price"),
        )
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two models' outputs in long form, by rules over the events; each model skips some times."""
    e = events(spark, folder)
    rules = F.array(
        F.struct(
            F.lit("rf").alias("model"),
            F.when(F.col("event_type") != "error", (F.col("value") > 40).cast("int")).alias("y_pred"),
            (1 / (1 + F.exp((40 - F.col("value")) / 50))).alias("proba_up"),
        ),
        F.struct(
            F.lit("gbt").alias("model"),
            F.when(F.col("event_type") != "view", (F.col("value") > 30).cast("int")).alias("y_pred"),
            (1 / (1 + F.exp((30 - F.col("value")) / 50))).alias("proba_up"),
        ),
    )
    rows = e.select("event_id", F.col("ts").alias("datetime"), (F.col("user_id") % 2).cast("int").alias("y_true"), F.explode(rules).alias("_r"))
    return rows.select("event_id", "datetime", "y_true", "_r.*").where(F.col("y_pred").isNotNull())


PREDICTIONS_SQL = """predictions AS (
  SELECT event_id, ts AS datetime, user_id % 2 AS y_true, 'rf' AS model, CAST(value > 40 AS INT) AS y_pred,
         1 / (1 + exp((40 - value) / 50)) AS proba_up FROM events WHERE event_type <> 'error'
  UNION ALL
  SELECT event_id, ts, user_id % 2, 'gbt', CAST(value > 30 AS INT), 1 / (1 + exp((30 - value) / 50))
  FROM events WHERE event_type <> 'view')"""

TICKS = Series(("series_id",), "ts", ("event_id",))
BARS = Series(("series_id",), "ts")

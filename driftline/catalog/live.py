"""Streaming jobs, run over what has landed until nothing is left."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from driftline.catalog.base import AXES, AXIS_OF, NEWS_SQL, PRICES_SQL, Shape, query
from driftline.catalog.features import MEANS, SHOCKS, rolled_sql, wide_sql
from driftline.plans.score import decide
from driftline.session import scratch_path, table
from driftline.streaming import jobs

NTZ = "timestamp_ntz"


def landed(spark, d):
    """The events file as a stream."""
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(os.path.join(d, "events*.parquet"))


def live_news(spark, d):
    axis = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in AXIS_OF.items()])
    score = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("value") - 50) / 100))
    return landed(spark, d).select(
        F.col("ts").alias("published_at"), F.lit("market").alias("series_id"), axis.alias("axis"), score.alias("sentiment_score")
    )


CLOSED = "bucket + INTERVAL 4 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"
WIDE_REALS = " ".join(MEANS + [f"sentiment_std_{a}" for a in AXES])
WIDE_INTS = " ".join([f"sentiment_count_{a}" for a in AXES] + ["total_count"])


@query(
    Shape("series_id bucket", WIDE_INTS, ((7, WIDE_REALS),)),
    f"WITH {NEWS_SQL}, {wide_sql('series_id', '4 hours')} FINAL SELECT * FROM wide WHERE {CLOSED}",
)
def stream_bucket_agg(spark, d):
    """Buckets the watermark has closed."""
    target, state = scratch_path(spark, "buckets"), scratch_path(spark, "state")
    jobs.run_available(jobs.stream_bucket_agg(live_news(spark, d), ["series_id"], "published_at", "4 hours", AXES), target, state)
    return spark.read.parquet(target).withColumn("bucket", F.col("bucket").cast(NTZ))


@query(
    Shape("series_id bucket", "n_points", ((4, "open high low close"),)),
    f"""WITH {PRICES_SQL}, bars AS (SELECT series_id, time_bucket(INTERVAL '4 hours', ts) AS bucket, arg_min(price, struct_pack(a := ts, b := event_id)) AS open,
    max(price) AS high, min(price) AS low, arg_max(price, struct_pack(a := ts, b := event_id)) AS close, count(*) AS n_points FROM prices GROUP BY 1, 2)
    FINAL SELECT * FROM bars WHERE {CLOSED}""",
)
def stream_ohlc(spark, d):
    target, state = scratch_path(spark, "candles"), scratch_path(spark, "state")
    points = landed(spark, d).select(F.col("event_type").alias("series_id"), "ts", "event_id", F.col("value").alias("price"))
    jobs.run_available(jobs.stream_ohlc(points, ["series_id"], "ts", "price", "4 hours", tie="event_id"), target, state)
    return spark.read.parquet(target).withColumn("bucket", F.col("bucket").cast(NTZ))


@query(
    Shape("ts", "event_id user_id"),
    "FINAL SELECT event_id, user_id, ts FROM events",
)
def stream_dedupe(spark, d):
    """The feed doubled; each event comes out once."""
    target, state = scratch_path(spark, "deduped"), scratch_path(spark, "state")
    doubled = landed(spark, d).select("event_id", "user_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    jobs.run_available(jobs.stream_dedupe(doubled, ["event_id"], "ts", "2 days"), target, state)
    return spark.read.parquet(target).withColumn("ts", F.col("ts").cast(NTZ))


@query(
    Shape("series_id bucket", "prediction " + " ".join(f"{c}_shock" for c in MEANS), ((6, " ".join(f"{c}_roll_mean {c}_momentum" for c in MEANS) + " proba_up"),)),
    f"""WITH {NEWS_SQL}, wide_all AS (WITH {wide_sql('series_id', '4 hours')} SELECT * FROM wide), wide AS (SELECT * FROM wide_all WHERE {CLOSED}), {rolled_sql('series_id')}
    FINAL SELECT *, {SHOCKS}, coalesce(1 / (1 + exp(-3.0 * sentiment_total_mean_momentum)), 0.5) AS proba_up,
    CASE WHEN sentiment_total_mean_momentum IS NOT NULL AND 1 / (1 + exp(-3.0 * sentiment_total_mean_momentum)) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM rolled""",
)
def stream_scored_features(spark, d):
    """Closed buckets roll onto the stored tail of each series and are scored in the same micro-batch."""
    root, state = scratch_path(spark, "features"), scratch_path(spark, "state")

    def score(rows):
        z = 3.0 * F.col("sentiment_total_mean_momentum")
        return decide(rows.withColumn("proba_up", 1 / (1 + F.exp(-z))))

    closed = jobs.stream_bucket_agg(live_news(spark, d), ["series_id"], "published_at", "4 hours", AXES)
    jobs.stream_features(closed, ["series_id"], root, state, MEANS, score)
    return spark.read.parquet(os.path.join(root, "features")).withColumn("bucket", F.col("bucket").cast(NTZ))

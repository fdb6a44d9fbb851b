"""Streams over several landed files give what the batch gives, also across restarts and replays."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftline.operators.buckets import sentiment_null_policy, sentiment_wide
from driftline.operators.ordered import Series
from driftline.operators.rolling import rolling_block
from driftline.streaming import jobs

AXES = ("BTC", "MACRO")
MEANS = ["sentiment_mean_BTC", "sentiment_mean_MACRO", "sentiment_total_mean"]
T0 = dt.datetime(2026, 1, 1)


def rows(day):
    return [
        (k, T0 + dt.timedelta(days=day, minutes=7 * i), AXES[i % 2], ((i * 13 + day * 5) % 17 - 8) / 8)
        for k in ("x", "y")
        for i in range(180)
    ]


def land(spark, folder, day):
    df = spark.createDataFrame(rows(day), "k string, published_at timestamp, axis string, sentiment_score double")
    df.coalesce(1).write.mode("append").parquet(folder)


def closed_stream(spark, folder):
    schema = "k string, published_at timestamp, axis string, sentiment_score double"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return jobs.stream_bucket_agg(source, ["k"], "published_at", "1 hour", AXES, "30 minutes")


def test_buckets_equal_batch(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for day in range(3):
        land(spark, folder, day)
        jobs.run_available(closed_stream(spark, folder), out, state)
    got = spark.read.parquet(out)
    batch = sentiment_null_policy(sentiment_wide(spark.read.parquet(folder), ["k"], "published_at", "1 hour", AXES))
    edge = batch.agg(F.max("bucket")).first()[0]
    want = batch.where(F.col("bucket") < F.lit(edge))
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert got.count() > 0
    assert rounded(got).exceptAll(rounded(batch).select(got.columns)).count() == 0
    # only the buckets the watermark has not passed are missing
    assert want.join(got, ["k", "bucket"], "left_anti").count() <= 2


def test_features_continue_across_batches(spark, tmp_path):
    folder, root, state = (str(tmp_path / n) for n in ("in", "root", "state"))
    for day in range(3):
        land(spark, folder, day)
        jobs.stream_features(closed_stream(spark, folder), ["k"], root, state, MEANS)
    got = spark.read.parquet(os.path.join(root, "features")).drop("epoch")
    assert spark.read.parquet(os.path.join(root, "features")).select("epoch").distinct().count() > 1
    batch = sentiment_null_policy(sentiment_wide(spark.read.parquet(folder), ["k"], "published_at", "1 hour", AXES))
    whole = rolling_block(batch, Series(("k",), "bucket"), MEANS)
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert rounded(got).exceptAll(rounded(whole).select(got.columns)).count() == 0


def test_replayed_epoch_overwrites(spark, tmp_path):
    handle = jobs.feature_writer(["k"], str(tmp_path), ["m"])
    first = spark.createDataFrame([("x", T0 + dt.timedelta(hours=i), float(i)) for i in range(5)], "k string, bucket timestamp, m double")
    later = spark.createDataFrame([("x", T0 + dt.timedelta(hours=i), float(i)) for i in range(5, 9)], "k string, bucket timestamp, m double")
    handle(first, 0)
    handle(later, 1)
    handle(later, 1)
    out = spark.read.parquet(os.path.join(str(tmp_path), "features"))
    assert out.count() == 9
    assert out.where("m = 5").first()["m_roll_mean"] == pytest.approx(2.0)
    assert out.where("m = 8").first()["m_roll_mean"] == pytest.approx(4.0)


def test_dedupe_within_delay(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, folder, 0)
    land(spark, folder, 0)
    source = spark.readStream.schema("k string, published_at timestamp, axis string, sentiment_score double").parquet(folder)
    jobs.run_available(jobs.stream_dedupe(source, ["k", "published_at"], "published_at", "2 days"), out, state)
    assert spark.read.parquet(out).count() == 360

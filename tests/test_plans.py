"""Physical plans: filters reach the scan, columns are pruned, windows are partitioned, shuffles are counted."""

import re

import pytest
from pyspark.sql import functions as F

from driftline.catalog import load
from driftline.catalog.base import BARS, candles, events, news, prices
from driftline.operators import clean, joins
from driftline.operators.buckets import ohlc_resample
from driftline.operators.ordered import Series, over_series
from driftline.plans.price import price_features
from driftline.plans.sentiment import sentiment_features
from driftline.sources.windows import candle_window

D = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    text = plan(df).split("== Initial Plan ==")[-1]
    return len(re.findall(r"Exchange hashpartitioning", text)) + len(re.findall(r"Exchange rangepartitioning", text))


def test_range_filters_are_pushed(spark):
    text = plan(clean.between_days(events(spark, D).select("event_id", "ts"), "ts", "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", text)
    assert "GreaterThanOrEqual(ts" in plan(candle_window(events(spark, D), "ts", "1h", now="2024-01-05"))


def test_feature_job_shuffles_twice(spark):
    # buckets by (series, window), then the ordered part by series
    assert shuffles(sentiment_features(news(spark, D), ["user_id"], freq="4 hours")) == 2
    assert shuffles(price_features(candles(spark, D), BARS, "1h", split=False)) == 2


def test_candles_read_three_columns_and_combine_before_the_shuffle(spark):
    text = plan(ohlc_resample(prices(spark, D), ["series_id"], "ts", "price", "1 hour"))
    assert "partial_max" in text and "partial_min_by" in text
    assert "props" not in text and "user_id" not in text


def test_asof_shuffles_once_and_never_pairs(spark):
    e = events(spark, D)
    left, right = e.where("event_type = 'view'"), e.where("event_type = 'click'")
    got = joins.asof_join(left, right, ["user_id"], "ts", "ts", ["value"], split=False)
    assert shuffles(got) == 1
    assert "Join" not in plan(got)


def test_split_series_shuffle_the_rows_once(spark):
    series = Series(("series_id",), "ts", ("event_id",), chunk_seconds=86400)
    got = over_series(prices(spark, D), series, lambda w: {"p": F.lag("price", 3).over(w)}, back=3, split=True)
    # rows once, and the few edge rows: found, counted, matched to their targets
    assert shuffles(got) <= 6
    assert "WindowGroupLimit" in plan(got)


@pytest.mark.parametrize("name", ["regimes_half_open", "request_plan", "tagged_documents", "keyword_sentiment", "scalar_transforms"])
def test_row_local_jobs_join_nothing(spark, name):
    text = plan(load()[name].run(spark, D))
    assert "Join" not in text and "CartesianProduct" not in text

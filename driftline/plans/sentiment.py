"""Scored news to model features, per series and time bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.text import AXES
from driftline.operators.buckets import regular_spine, sentiment_null_policy, sentiment_wide
from driftline.operators.clean import dedupe_first
from driftline.operators.joins import fill_from_index, index_asof
from driftline.operators.ordered import Series
from driftline.operators.rolling import rolling_block

RATIO_GUARD = 1e-6


def sentiment_features(
    news: DataFrame,
    keys: Sequence[str],
    ts: str = "published_at",
    freq: str = "1 hour",
    axes: Sequence[str] = AXES,
    axis: str = "axis",
    score: str = "sentiment_score",
    index: DataFrame | None = None,
    index_ts: str = "datetime",
    index_value: str = "fear_greed_index",
    index_mode: str = "exact",
    compat: bool = False,
    spine: bool = False,
) -> DataFrame:
    """Aggregate, pivot, fill, roll and join the daily index.

    Lags and windows count rows, so they skip empty buckets; ``spine`` adds those as rows first.

    One shuffle reduces the articles to buckets. The ordered part then runs on at most one row per series and
    bucket, a number set by the time span and not by the article volume, so it is windowed per series.
    """
    wide = sentiment_wide(news, keys, ts, freq, axes, axis, score)
    if spine:
        wide = regular_spine(wide, keys, "bucket", freq)
    wide = sentiment_null_policy(wide, compat)
    means = [c for c in wide.columns if "mean" in c]
    series = Series(tuple(keys), "bucket")
    out = rolling_block(wide, series, means, split=False)
    if "BTC" in axes and "MACRO" in axes:
        out = out.withColumns(
            {
                "div_btc_macro": F.col("sentiment_mean_BTC") - F.col("sentiment_mean_MACRO"),
                "news_ratio_btc_macro": F.col("sentiment_count_BTC") / (F.col("sentiment_count_MACRO") + RATIO_GUARD),
            }
        )
    if index is None:
        return out.withColumn("fear_greed_index", F.lit(50.0))
    if index_mode == "exact":
        days = dedupe_first(index, [index_ts], [index_ts, index_value])
        return fill_from_index(out, days, series, index_ts, index_value, "fear_greed_index", split=False)
    return index_asof(out, index, "bucket", index_ts, index_value, "fear_greed_index")

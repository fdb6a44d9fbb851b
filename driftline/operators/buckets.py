"""Time bucket aggregates: axis sentiment, OHLC, resampling, daily volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.temporal import epoch_us, floor_ts
from driftline.operators.clean import numeric_columns
from driftline.session import join_same, settle

# A calendar label closes its period, as in the pandas month-end rule.
CALENDAR = {"month": "month", "quarter": "quarter", "year": "year"}
FIXED_SECONDS = {"1 hour": 3600, "4 hours": 4 * 3600, "1 day": 24 * 3600}


def bucket_axis_agg(df: DataFrame, keys: Sequence[str], ts: str, freq: str, axis="axis", score="sentiment_score"):
    """Mean, non-null count and sample deviation per observed (bucket, axis); rows without an axis are left out."""
    return (
        df.where(F.col(axis).isNotNull())
        .groupBy(*keys, floor_ts(ts, freq).alias("bucket"), axis)
        .agg(
            F.avg(score).alias("sentiment_mean"),
            F.count(score).alias("sentiment_count"),
            F.stddev_samp(score).alias("sentiment_std"),
        )
    )


def bucket_total(df: DataFrame, keys: Sequence[str], ts: str, freq: str, score="sentiment_score") -> DataFrame:
    return df.groupBy(*keys, floor_ts(ts, freq).alias("bucket")).agg(
        F.avg(score).alias("sentiment_total_mean"), F.count(score).alias("total_count")
    )


def _start_first(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in grouped.columns if c not in (*keys, "_w")]
    return grouped.select(*keys, F.col("_w.start").alias("bucket"), *rest)


def sentiment_wide(
    df: DataFrame, keys: Sequence[str], ts: str, freq: str, axes: Sequence[str], axis="axis", score="sentiment_score"
) -> DataFrame:
    """Per-axis and overall aggregates side by side, one aggregate and one shuffle.

    A bucket whose rows all lack an axis is absent, as it would be after a pivot.
    """
    aggs: list[Column] = []
    for a in axes:
        x = F.when(F.col(axis) == a, F.col(score))
        aggs += [
            F.avg(x).alias(f"sentiment_mean_{a}"),
            F.count(x).alias(f"sentiment_count_{a}"),
            F.stddev_samp(x).alias(f"sentiment_std_{a}"),
        ]
    # grouping by the whole window, not its start, keeps the watermark of a stream
    grouped = (
        df.groupBy(*keys, F.window(ts, freq).alias("_w"))
        .agg(
            *aggs,
            F.avg(score).alias("sentiment_total_mean"),
            F.count(score).alias("total_count"),
            F.count_if(F.col(axis).isin(*axes)).alias("_tagged"),
        )
        .where(F.col("_tagged") > 0)
    )
    return _start_first(grouped, keys).drop("_tagged")


def sentiment_null_policy(wide: DataFrame, compat: bool = False) -> DataFrame:
    """Absent means are 0 and zero counts are null; ``compat`` also blanks every deviation."""
    changes = {}
    for c in wide.columns:
        if "mean" in c:
            changes[c] = F.coalesce(F.col(c), F.lit(0.0))
        elif "count" in c:
            changes[c] = F.when(F.col(c) > 0, F.col(c))
        elif "std" in c and compat:
            changes[c] = F.lit(None).cast("double")
    return wide.withColumns(changes)


def ohlc_resample(df: DataFrame, keys: Sequence[str], ts: str, price: str, freq: str, tie: str | None = None):
    """First, highest, lowest and last known price per bucket.

    With times unique per series leave ``tie`` out: a plain time order is hashed, a pair has to be sorted.
    """
    order = F.struct(ts, tie) if tie else F.col(ts)
    grouped = (
        df.where(F.col(price).isNotNull())
        .groupBy(*keys, F.window(ts, freq).alias("_w"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.count("*").alias("n_points"),
        )
    )
    return _start_first(grouped, keys)


def candle_density(df: DataFrame, keys: Sequence[str], ts: str, price: str, freq: str, min_points: int = 2):
    """Share of buckets, empty ones between first and last included, with enough points."""
    per = (
        df.where(F.col(price).isNotNull())
        .groupBy(*keys, floor_ts(ts, freq).alias("bucket"))
        .agg(F.count("*").alias("n_points"))
    )
    return density_of(per, keys, freq, min_points)


def density_of(per_bucket: DataFrame, keys: Sequence[str], freq: str, min_points: int = 2) -> DataFrame:
    step = FIXED_SECONDS[freq] * 1_000_000
    slots = (epoch_us(F.max("bucket")) - epoch_us(F.min("bucket"))) / F.lit(step) + 1
    return per_bucket.groupBy(*keys).agg(
        slots.cast("long").alias("n_slots"),
        F.count_if(F.col("n_points") >= min_points).alias("n_dense"),
        (F.count_if(F.col("n_points") >= min_points) / slots).alias("density"),
    )


def build_ohlc(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "datetime",
    freq: str = "1 hour",
    min_points: int = 2,
    min_density: float = 0.60,
    tie: str | None = None,
) -> DataFrame:
    """Candles with a ``mode``: given columns as they are, computed ones for dense series, none in line mode.

    A series in line mode yields one row with null prices.
    """
    if {"open", "high", "low", "close"} <= set(df.columns):
        return (
            df.where(F.col("close").isNotNull())
            .select(*keys, F.col(ts).alias("bucket"), "open", "high", "low", "close")
            .withColumn("mode", F.lit("ohlc"))
        )
    if "price" not in df.columns or ts not in df.columns:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("open", "high", "low", "close")]
        stamp = F.lit(None).cast("timestamp").alias("bucket")
        return df.select(*keys).distinct().select(*keys, stamp, *nothing).withColumn("mode", F.lit("line"))
    candles = ohlc_resample(df, keys, ts, "price", freq, tie)
    whole = Window.partitionBy(*keys)
    step = FIXED_SECONDS[freq] * 1_000_000
    slots = (epoch_us(F.max("bucket").over(whole)) - epoch_us(F.min("bucket").over(whole))) / F.lit(step) + 1
    dense = F.count_if(F.col("n_points") >= min_points).over(whole) / slots
    first = F.row_number().over(whole.orderBy("bucket")) == 1
    out = candles.withColumns({"_dense": dense >= min_density, "_first": first}).where("_dense or _first")
    return out.select(
        *keys,
        *[F.when(F.col("_dense"), F.col(c)).alias(c) for c in ("bucket", "open", "high", "low", "close")],
        F.when(F.col("_dense"), "computed_ohlc").otherwise("line").alias("mode"),
    )


def _labels(ts: str, kind: str, freqs: Sequence[str]) -> Column:
    marks = []
    for f in freqs:
        if f in CALENDAR:
            step = {"month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}[f]
            amount, unit = step.split()
            label = F.date_trunc(f, F.col(ts)).cast(kind) + F.expr(f"INTERVAL '{amount}' {unit}") - F.expr("INTERVAL '1' DAY")
        else:
            us = FIXED_SECONDS[f]
            t = F.col(ts).cast("timestamp")
            secs = F.unix_seconds(F.date_trunc("second", t))
            label = F.timestamp_seconds(secs - F.pmod(secs, F.lit(us))).cast(kind)
        marks.append(F.struct(F.lit(f).alias("freq"), label.cast(kind).alias("bucket")))
    return F.array(*marks)


def resample_mean(df: DataFrame, keys: Sequence[str], ts: str, freqs: Sequence[str], cols: Sequence[str] | None = None):
    """Mean of every numeric column at several frequencies, in one pass.

    Rows are reduced to the finest buckets by sum and count before they fan out to the coarser ones.
    """
    kind = dict(df.dtypes)[ts]
    cols = [c for c in (cols or numeric_columns(df)) if c not in keys]
    finest = min((FIXED_SECONDS[f], f) for f in freqs if f in FIXED_SECONDS)[1] if set(freqs) & set(FIXED_SECONDS) else None
    base = finest or "1 day"
    partial = df.groupBy(*keys, floor_ts(ts, base).alias("_b")).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols]
    )
    spread = partial.withColumn("_m", F.explode(_labels("_b", kind, freqs)))
    return spread.groupBy(*keys, F.col("_m.freq").alias("freq"), F.col("_m.bucket").alias("bucket")).agg(
        *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(c) for c in cols]
    )


def volume_per_day(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows per day between the first and last day of each key; empty days are 0."""
    daily = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    bounds = daily.groupBy(*keys).agg(F.min("day").alias("_a"), F.max("day").alias("_z"))
    spine = bounds.select(*keys, F.explode(F.sequence("_a", "_z")).alias("day"))
    return join_same(spine, daily, [*keys, "day"], "left").select(*keys, "day", F.coalesce("n", F.lit(0)).alias("n"))


def regular_spine(df: DataFrame, keys: Sequence[str], ts: str, freq: str) -> DataFrame:
    """Reindex every series to a full grid; missing steps are null rows."""
    df = settle(df)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_z"))
    step = F.expr(f"INTERVAL {freq}")
    spine = bounds.select(*keys, F.explode(F.sequence("_a", "_z", step)).alias(ts))
    return join_same(spine, df, [*keys, ts], "left")

"""Data-quality and exploration tables, each one aggregate over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.numeric import label_by
from driftline.functions.temporal import freq_of_granularity, granularity_of, seconds_between
from driftline.operators.clean import numeric_columns
from driftline.operators.ordered import Series, over_series
from driftline.operators.quantiles import exact_quantiles
from driftline.session import join_same, pin, settle


def _long(df: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    """One-row wide table to (column, value)."""
    return df.unpivot([], [F.col(f"`{c}`") for c in cols], name, value)


def null_ratio(df: DataFrame, top: int | None = 15) -> DataFrame:
    """Share of nulls per column, largest first."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    out = _long(wide, df.columns, "column_name", "ratio").orderBy(F.desc("ratio"), "column_name")
    return out.limit(top) if top else out


def zero_ratio(df: DataFrame, top: int | None = 15) -> DataFrame:
    """Share of exact zeros per numeric column over all rows, largest first."""
    cols = numeric_columns(df)
    wide = df.agg(*[F.avg(F.coalesce((F.col(c) == 0).cast("double"), F.lit(0.0))).alias(c) for c in cols])
    out = _long(wide, cols, "column_name", "ratio").orderBy(F.desc("ratio"), "column_name")
    return out.limit(top) if top else out


def class_balance(df: DataFrame, col: str) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.join(F.broadcast(total), F.lit(True)).select(col, "n", (F.col("n") / F.col("_all")).alias("share"))


def describe(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per column, one row per (key, column)."""
    df = settle(df.select(*keys, *cols))
    marks = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in cols]))
    long = df.select(*keys, marks.alias("_m")).select(*keys, "_m.column_name", "_m._v")
    by = [*keys, "column_name"]
    basic = long.groupBy(*by).agg(
        F.count("_v").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    q = exact_quantiles(long, by, "_v", [0.25, 0.5, 0.75])
    quart = q.select(*by, F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"))
    return join_same(basic, quart, by, "left").select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def corr_with_target(df: DataFrame, targets: Sequence[str], cols: Sequence[str] | None = None, top: int | None = 15):
    """Pearson correlation of every numeric column with each target, strongest first, ``top`` per target."""
    cols = list(cols or numeric_columns(df))
    wide = df.agg(*[F.corr(c, t).alias(f"{t}|{c}") for t in targets for c in cols])
    long = _long(wide, wide.columns, "_pair", "r").select(
        F.split("_pair", r"\|")[0].alias("target"), F.split("_pair", r"\|")[1].alias("column_name"), "r"
    )
    w = Window.partitionBy("target").orderBy(F.abs("r").desc_nulls_last(), "column_name")
    ranked = long.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= top) if top else ranked


def quantile_bins(df: DataFrame, feature: str, bins: int = 5) -> DataFrame:
    """Add ``bin``, ``lo`` and ``hi``: intervals (lo, hi] between linear quantiles, the lowest closed on both sides.

    Equal edges collapse. The edges are one small row.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = pin(exact_quantiles(df, [], feature, probs).select(F.array_distinct("q").alias("_e")))
    x = F.col(feature)
    # edges strictly below x; the lowest edge itself belongs to the first bin
    at = F.greatest(F.lit(1), F.size(F.filter("_e", lambda e: e < x)))
    return (
        df.where(x.isNotNull())
        .join(edges, F.lit(True))  # one row
        .withColumn("bin", at)
        .withColumns({"lo": F.col("_e")[F.col("bin") - 1], "hi": F.col("_e")[F.col("bin")]})
        .drop("_e")
    )


def conditional_analysis(df: DataFrame, feature: str, bins: int = 5, ret="future_return", up="target_up") -> DataFrame:
    known = settle(df.select(feature, ret, up).na.drop())
    return (
        quantile_bins(known, feature, bins)
        .groupBy("bin", "lo", "hi")
        .agg(F.count("*").alias("count"), F.avg(ret).alias("mean_return"), F.avg(up).alias("up_rate"))
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width counts between minimum and maximum, the last bin closed; empty bins are 0."""
    x = F.col(col).cast("double")
    known = settle(df.select(x.alias("_x")).where(F.col("_x").isNotNull()))
    span = F.broadcast(known.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.lit(bins), F.coalesce(F.width_bucket("_x", "_lo", "_hi", F.lit(bins)), F.lit(1)))
    counts = known.join(span, F.lit(True)).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    grid = span.select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"), "_lo", width.alias("_w"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * F.col("_w")).alias("lo"),
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def sentiment_summary(df: DataFrame, keys: Sequence[str], score: str, cut: float = 0.05) -> DataFrame:
    """Mean score (0 without any), strong positive and negative counts, and the label at the cut."""
    return (
        df.groupBy(*keys)
        .agg(
            F.coalesce(F.avg(score), F.lit(0.0)).alias("score"),
            F.count_if(F.col(score) > cut).alias("pos_hits"),
            F.count_if(F.col(score) < -cut).alias("neg_hits"),
        )
        .withColumn("label", label_by("score", cut))
    )


def score_stats(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    s = F.col(score)
    n = F.count("*")
    parts = {"positive": F.count_if(s > 0), "negative": F.count_if(s < 0), "neutral": F.count_if(s == 0)}
    return df.groupBy(*keys).agg(
        F.avg(s).alias("mean"),
        F.stddev_samp(s).alias("std"),
        *[c.alias(f"n_{k}") for k, c in parts.items()],
        *[(100.0 * c / n).alias(f"pct_{k}") for k, c in parts.items()],
    )


def daily_model_mean(long: DataFrame, ts: str, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean prediction per day and model of an unpivoted table."""
    return long.groupBy(F.to_date(ts).alias("day"), *keys).agg(F.avg("pred").alias("mean_pred"))


def coverage(df: DataFrame, keys: Sequence[str], ts: str, source: str | None = None) -> DataFrame:
    aggs = [
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        seconds_between(F.max(ts), F.min(ts)).alias("duration_s"),
        F.count("*").alias("n_rows"),
    ]
    if source:
        aggs.append(F.count_distinct(source).alias("n_sources"))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def time_steps(df: DataFrame, series: Series, split: bool | None = None) -> DataFrame:
    """Seconds since the previous row of the series."""
    out = over_series(df, series, lambda w: {"_prev": F.lag(series.ts, 1).over(w)}, back=1, split=split)
    return out.withColumn("delta_s", seconds_between(series.ts, "_prev")).drop("_prev")


def cadence_report(df: DataFrame, series: Series, least_share: float = 0.7, fail: bool = False, split=None) -> DataFrame:
    """Most common step (smallest on a tie), smallest step, share at the mode, larger gaps, granularity and verdict."""
    keys = list(series.keys)
    steps = time_steps(df, series, split).where(F.col("delta_s").isNotNull())
    per = steps.groupBy(*keys, "delta_s").agg(F.count("*").alias("_n"))
    # the mode by partial aggregation; then gaps against it over the step tallies
    mode = per.groupBy(*keys).agg(
        F.min_by("delta_s", F.struct(-F.col("_n"), "delta_s")).alias("mode_s"),
        F.min("delta_s").alias("min_s"),
        F.sum("_n").alias("n_steps"),
        F.max("_n").alias("n_mode"),
    )
    gaps = (
        join_same(per, mode.select(*keys, "mode_s"), keys)
        .where(F.col("delta_s") > F.col("mode_s"))
        .groupBy(*keys)
        .agg(F.sum("_n").alias("_g"), F.max("delta_s").alias("max_gap_s"))
    )
    share = F.col("n_mode") / F.col("n_steps")
    out = join_same(mode, gaps, keys, "left").select(
        *keys,
        "mode_s",
        "min_s",
        share.alias("mode_share"),
        (1 - share).alias("irregularity"),
        F.coalesce("_g", F.lit(0)).alias("n_gaps"),
        "max_gap_s",
        granularity_of("mode_s").alias("granularity"),
        freq_of_granularity(granularity_of("mode_s")).alias("freq"),
        F.when(share >= least_share, "regular").otherwise("irregular").alias("verdict"),
    )
    if fail:
        ok = F.when(F.col("verdict") == "irregular", F.raise_error(F.lit("series is not regular enough")))
        out = out.withColumn("verdict", F.coalesce(ok.cast("string"), F.col("verdict")))
    return out


def gap_sample(df: DataFrame, series: Series, longer_than_s: float, n: int = 10, split=None) -> DataFrame:
    """The longest gaps."""
    found = time_steps(df, series, split).where(F.col("delta_s") > longer_than_s)
    return found.select(*series.keys, series.ts, "delta_s").orderBy(F.desc("delta_s"), *series.keys, series.ts).limit(n)


def monotonic_check(df: DataFrame, series: Series, ts: str, split=None) -> DataFrame:
    """Rows whose time lies before that of the row ahead of them in arrival order (``series`` orders by arrival)."""
    out = over_series(df, series, lambda w: {"_prev": F.lag(ts, 1).over(w)}, back=1, split=split)
    back: Column = F.col(ts) < F.col("_prev")
    return out.groupBy(*series.keys).agg(F.count("*").alias("n_rows"), F.count_if(back).alias("n_backward"))

"""Row-ordered features: rolling statistics, shocks, lags, returns, differences, targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from driftline.functions.numeric import null_if_zero
from driftline.operators.ordered import Series, over_series
from driftline.operators.quantiles import exact_quantiles
from driftline.session import join_same, pin, settle

ROLL_ROWS = 7
ROLL_MIN = 3
SHOCK = 2.0


def past_mean(x: Column, w: WindowSpec, rows: int = ROLL_ROWS, least: int = ROLL_MIN) -> Column:
    past = w.rowsBetween(-rows, -1)
    return F.when(F.count(x).over(past) >= least, F.avg(x).over(past))


def past_std(x: Column, w: WindowSpec, rows: int = ROLL_ROWS, least: int = ROLL_MIN) -> Column:
    past = w.rowsBetween(-rows, -1)
    return F.when(F.count(x).over(past) >= least, F.stddev_samp(x).over(past))


def full_std(x: Column, w: WindowSpec, rows: int) -> Column:
    """Sample deviation of the last ``rows`` values, null until all are known."""
    upto = w.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(x).over(upto) >= rows, F.stddev_samp(x).over(upto))


def full_mean(x: Column, w: WindowSpec, rows: int) -> Column:
    upto = w.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(x).over(upto) >= rows, F.avg(x).over(upto))


def shock(x: Column, mean: Column, std: Column, width: float = SHOCK) -> Column:
    return F.when(x > mean + width * std, 1).when(x < mean - width * std, -1).otherwise(0)


def pct_change(x: Column, w: WindowSpec, n: int) -> Column:
    return F.try_divide(x, F.lag(x, n).over(w)) - 1


def rolling_block(df: DataFrame, series: Series, cols: Sequence[str], split: bool | None = None) -> DataFrame:
    """Per column: past mean and deviation, shock, momentum and first lag. The current row never feeds its own window."""

    def stats(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in cols:
            out[f"{c}_roll_mean"] = past_mean(F.col(c), w)
            out[f"{c}_roll_std"] = past_std(F.col(c), w)
            out[f"{c}_momentum"] = F.col(c) - F.lag(c, 1).over(w)
            out[f"{c}_lag1"] = F.lag(c, 1).over(w)
        return out

    def flags(_: WindowSpec) -> dict[str, Column]:
        return {
            f"{c}_shock": shock(F.col(c), F.col(f"{c}_roll_mean"), F.col(f"{c}_roll_std")) for c in cols
        }

    return over_series(df, series, stats, flags, back=ROLL_ROWS, split=split)


def lag_columns(df: DataFrame, series: Series, col: str, lags: Sequence[int], split: bool | None = None) -> DataFrame:
    return over_series(
        df, series, lambda w: {f"{col}_lag_{n}": F.lag(col, n).over(w) for n in lags}, back=max(lags), split=split
    )


def moving_average(df: DataFrame, series: Series, col: str, rows: int = 24, out="ma", split: bool | None = None):
    """Mean of up to ``rows`` rows ending here."""
    return over_series(
        df, series, lambda w: {out: F.avg(col).over(w.rowsBetween(-(rows - 1), 0))}, back=rows - 1, split=split
    )


def returns(df: DataFrame, series: Series, col: str, method: str = "log", out="ret", split: bool | None = None):
    """Log or plain first difference; rows without one are dropped."""
    if method not in ("log", "diff"):
        raise ValueError("method is 'log' or 'diff'")
    base = F.log(null_if_zero(col)) if method == "log" else F.col(col)
    got = over_series(df.withColumn("_y", base), series, lambda w: {out: F.col("_y") - F.lag("_y", 1).over(w)}, back=1, split=split)
    return got.drop("_y").where(F.col(out).isNotNull())


def quantile_clip(df: DataFrame, keys: Sequence[str], col: str, q: float = 0.01, min_rows: int = 50) -> DataFrame:
    """Hold each series to its own [q, 1-q] quantiles when it has more than ``min_rows`` values."""
    df = settle(df)
    edges = exact_quantiles(df, list(keys), col, [q, 1 - q]).select(
        *keys, F.col("n").alias("_n"), F.col("q")[0].alias("_lo"), F.col("q")[1].alias("_hi")
    )
    held = F.greatest(F.col("_lo"), F.least(F.col("_hi"), F.col(col)))
    return (
        join_same(df, pin(edges), list(keys), "left")
        .withColumn(col, F.when((F.col("_n") > min_rows) & F.col(col).isNotNull(), held).otherwise(F.col(col)))
        .drop("_n", "_lo", "_hi")
    )


def difference(
    df: DataFrame,
    series: Series,
    col: str,
    d: int = 0,
    seasonal: int = 0,
    period: int = 1,
    out="diff",
    lag_d: bool = False,
    split: bool | None = None,
) -> DataFrame:
    """``d`` repeated first differences and ``seasonal`` differences at ``period``; incomplete rows are dropped.

    ``lag_d`` takes one difference at lag ``d`` instead of repeating.
    """
    lags = ([d] if lag_d and d else [1] * d) + [period] * seasonal
    steps = [
        (lambda w, n=n: {out: F.col(out) - F.lag(out, n).over(w)}) for n in lags
    ]
    start = df.withColumn(out, F.col(col).cast("double"))
    got = over_series(start, series, *steps, back=sum(lags), split=split) if lags else start
    return got.where(F.col(out).isNotNull())


def future_target(df: DataFrame, series: Series, col: str = "close", horizon: int = 1, split: bool | None = None):
    """Return over the next ``horizon`` rows and whether it is positive; unknown at the end."""
    ahead = over_series(
        df,
        series,
        lambda w: {"future_return": F.try_divide(F.lead(col, horizon).over(w), F.col(col)) - 1},
        ahead=horizon,
        split=split,
    )
    return ahead.withColumn("target_up", (F.col("future_return") > 0).cast("int"))

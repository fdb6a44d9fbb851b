"""Which slices of a feed to read: request days per axis, candle look-back, axis tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.temporal import LOOKBACK_HOURS, seconds_of
from driftline.functions.text import AXES, AXIS_RULES, AxisRule, matched_axes


def request_plan(df: DataFrame, start: Column | str, end: Column | str, axes: Sequence[str] = AXES) -> DataFrame:
    """One row per day of each row's [start, end] and axis. Rows fan out in place, without a join."""
    a = F.col(start) if isinstance(start, str) else start
    z = F.col(end) if isinstance(end, str) else end
    days = df.withColumn("day", F.explode(F.sequence(F.to_date(a), F.to_date(z))))
    return days.withColumn("axis", F.explode(F.array(*[F.lit(x) for x in axes])))


def live_request_plan(df: DataFrame, now: Column | str, hours: int = 24, axes: Sequence[str] = AXES) -> DataFrame:
    """Whole days that cover the last ``hours``."""
    n = F.col(now) if isinstance(now, str) else now
    return request_plan(df, n - F.expr(f"INTERVAL '{hours}' HOUR"), n, axes)


def missing_requests(
    plan: DataFrame, landed: DataFrame, ts: str = "published_at", axis: str = "axis", by: Sequence[str] = ()
) -> DataFrame:
    """Planned (``by``, day, axis) for which nothing has landed."""
    have = landed.select(*by, F.to_date(ts).alias("day"), axis).distinct()
    return plan.join(have, [*by, "day", axis], "left_anti")


def lookback_hours(resolution: str, reach: int = 0) -> int:
    """Hours of the live look-back; ``reach`` is how many rows the features computed next look back."""
    step = seconds_of(resolution)  # refuses what is no resolution
    return max(LOOKBACK_HOURS[resolution], (reach + 1) * step // 3600)


def candle_window(
    df: DataFrame,
    ts: str,
    resolution: str,
    now: str | None = None,
    start: str | None = None,
    end: str | None = None,
    reach: int = 0,
    bars: str | None = None,
) -> DataFrame:
    """Rows of the look-back before ``now``, or of [start, end]. The bounds are literals, so they reach the scan.

    ``reach`` is how many rows the features computed next look back; the window is widened to hold one more.
    With ``bars`` the rows are raw points: kept are the points of all bars of that length that open in the window.
    """
    kind = dict(df.dtypes)[ts]
    if now is not None:
        z = F.lit(now).cast(kind)
        a = z - F.expr(f"INTERVAL '{lookback_hours(resolution, reach)}' HOUR")
    elif start is None or end is None:
        raise ValueError("give now, or both start and end")
    elif end <= start:
        raise ValueError("end must be later than start")
    else:
        a, z = F.lit(start).cast(kind), F.lit(end).cast(kind)
    if bars is None:
        return df.where((F.col(ts) >= a) & (F.col(ts) <= z))
    edges = df.sparkSession.range(1).select(
        next_bar(a - F.expr("INTERVAL '1' MICROSECOND"), bars).cast("string").alias("a"),
        next_bar(z, bars).cast("string").alias("z"),
    ).first()
    return df.where((F.col(ts) >= F.lit(edges["a"]).cast(kind)) & (F.col(ts) < F.lit(edges["z"]).cast(kind)))


def next_bar(c: Column, bars: str) -> Column:
    """Opening time of the bar after the one that holds ``c``."""
    return F.window(c, bars).end


def newest(df: DataFrame, ts: str) -> str | None:
    """Latest time of a frame as text; one row comes back, from column statistics where the source keeps them."""
    return df.agg(F.max(ts).cast("string").alias("t")).first()["t"]


def live_days(df: DataFrame, ts: str, now: str, hours: int = 24) -> DataFrame:
    """What a live request finds landed at ``now``: whole days from the one that holds now minus ``hours``."""
    kind = dict(df.dtypes)[ts]
    z = F.lit(now).cast(kind)
    first = F.date_trunc("day", z - F.expr(f"INTERVAL '{hours}' HOUR")).cast(kind)
    return df.where((F.col(ts) >= first) & (F.col(ts) <= z))


def tag_axis(df: DataFrame, text: str, rules: tuple[AxisRule, ...] = AXIS_RULES, out: str = "axis") -> DataFrame:
    """One row per axis whose keyword rule the text meets."""
    return df.withColumn(out, F.explode(matched_axes(F.col(text), rules)))

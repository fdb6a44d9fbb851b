"""Candles to model features, with the column set each resolution's models expect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from driftline.functions.numeric import range_norm
from driftline.functions.temporal import monday_weekday, seconds_of
from driftline.operators.joins import asof_join
from driftline.operators.ordered import Series, over_series
from driftline.operators.rolling import full_mean, full_std, pct_change


@dataclass(frozen=True)
class Profile:
    """Which lags and windows make up the features of a resolution."""

    returns: tuple[int, ...]
    lags: tuple[int, ...]
    stds: tuple[int, ...]
    sma: int
    hour: bool

    @property
    def reach(self) -> int:
        return max(*self.returns, *self.lags, *(s + 1 for s in self.stds), self.sma)

    @property
    def columns(self) -> list[str]:
        names = [f"ret_{n}" for n in self.returns]
        names += [f"close_lag_{n}" for n in self.lags]
        names += [f"std_{n}" for n in self.stds]
        names += [f"mom_sma{self.sma}", "range_norm"]
        return names + (["hour"] if self.hour else []) + ["dayofweek"]


# Feature sets of the shipped models.
INTRADAY = Profile((1, 2, 4, 8, 24), (1, 2, 4), (8, 24), 24, True)
DAILY = Profile((1, 2, 7, 14, 30), (1, 2, 3), (7, 14), 30, False)
PROFILES = {"1h": INTRADAY, "4h": INTRADAY, "24h": DAILY}


def price_features(
    candles: DataFrame, series: Series, resolution: str = "1h", split: bool | None = None, **kw
) -> DataFrame:
    """Returns, lags, volatility, momentum, range and calendar columns next to OHLC."""
    seconds_of(resolution)
    p = PROFILES[resolution]
    close = F.col("close")

    def moves(w: WindowSpec) -> dict[str, Column]:
        out = {f"ret_{n}": pct_change(close, w, n) for n in p.returns}
        out |= {f"close_lag_{n}": F.lag("close", n).over(w) for n in p.lags}
        out[f"mom_sma{p.sma}"] = F.try_divide(close, full_mean(close, w, p.sma)) - 1
        return out

    def spread(w: WindowSpec) -> dict[str, Column]:
        return {f"std_{n}": full_std(F.col("ret_1"), w, n) for n in p.stds}

    out = over_series(candles, series, moves, spread, back=p.reach, split=split, **kw)
    extra = {"range_norm": range_norm("high", "low", "close"), "dayofweek": monday_weekday(series.ts)}
    if p.hour:
        extra["hour"] = F.hour(series.ts)
    out = out.withColumns(extra)
    return out.select(*series.keys, series.ts, "open", "high", "low", "close", *p.columns)


def features_at(
    targets: DataFrame,
    candles: DataFrame,
    series: Series,
    target_ts: str,
    resolution: str = "1h",
    strict: bool = False,
    split: bool | None = None,
) -> DataFrame:
    """Complete feature row nearest to each target, at most one step away (else null, or an error if ``strict``)."""
    feats = price_features(candles, series, resolution, split).na.drop()
    take = [c for c in feats.columns if c not in (*series.keys, series.ts)]
    return asof_join(
        targets,
        feats,
        series.keys,
        target_ts,
        series.ts,
        take,
        tolerance_s=seconds_of(resolution),
        prefix="",
        strict=strict,
        split=split,
    )

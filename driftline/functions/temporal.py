"""Time columns: flooring, parsing, epochs, weekday, granularity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
# Resolution name -> seconds.
RESOLUTION_SECONDS = {"1h": HOUR, "4h": 4 * HOUR, "24h": 24 * HOUR}
# Live look-back per resolution, in hours.
LOOKBACK_HOURS = {"1h": 24, "4h": 168, "24h": 30 * 24}
# Seasonal period candidates, in steps, per granularity.
PERIOD_CANDIDATES = {
    "1-hour": [24, 168, 336, 720, 1440],
    "4-hour": [6, 42, 84, 180],
    "1-day": [7, 14, 30, 90],
}
# Diagnostic lags, in steps, per granularity.
LAG_CANDIDATES = {
    "1-hour": [2, 6, 24, 48, 168],
    "4-hour": [2, 3, 6, 12, 42],
    "1-day": [2, 7, 14, 30],
}
GRANULARITY_FREQ = {"1-hour": "1 hour", "4-hour": "4 hours", "1-day": "1 day"}

# ISO first: a day-first rule must never touch ISO text.
TS_FORMATS = (
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm",
    "dd-MM-yyyy",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_of(resolution: str) -> int:
    if resolution not in RESOLUTION_SECONDS:
        raise ValueError(f"resolution must be one of {sorted(RESOLUTION_SECONDS)}, got {resolution!r}")
    return RESOLUTION_SECONDS[resolution]


def freq_of(resolution: str) -> str:
    return f"{seconds_of(resolution) // HOUR} hours"


def floor_ts(c: Column | str, freq: str) -> Column:
    """Start of the tumbling bucket, aligned to midnight."""
    return F.window(_col(c), freq).start


def epoch_us(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(1_000_000.0)


def parse_ts(c: Column | str, formats: tuple[str, ...] = TS_FORMATS) -> Column:
    """First format that reads the text; null when none does."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def monday_weekday(c: Column | str) -> Column:
    """Monday = 0."""
    return F.weekday(_col(c))


def granularity_of(seconds: Column | str) -> Column:
    s = _col(seconds)
    return (
        F.when(s.between(3500, 3700), "1-hour")
        .when(s.between(3.5 * HOUR, 4.5 * HOUR), "4-hour")
        .when(s.between(23 * HOUR, 25 * HOUR), "1-day")
        .otherwise("other")
    )


def freq_of_granularity(granularity: Column | str) -> Column:
    g = _col(granularity)
    out = F.lit(None).cast("string")
    for name, freq in GRANULARITY_FREQ.items():
        out = F.when(g == name, freq).otherwise(out)
    return out


def safe_lag(granularity: str, period: int | None, n: Column | int, cap: int = 300) -> Column:
    """Largest useful lag for a series of ``n`` rows; never below 10."""
    lags = list(LAG_CANDIDATES.get(granularity, []))
    if period and period > 1:
        lags += [period, 2 * period, 3 * period]
    rows = n if isinstance(n, Column) else F.lit(n)
    return F.greatest(F.lit(10), F.least(F.lit(max(lags, default=50)), F.lit(cap), rows - 2))

"""Scalar rules over numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Text or number to double; unparsable text and NaN become null."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def clip(c: Column | str, low: float, high: float) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c)))


def null_if_zero(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(0.0))


def rel_diff(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(F.abs(_col(a) - _col(b)), F.abs(_col(b)))


def blend(a: Column | str, b: Column | str, wa: float = 0.7, wb: float = 0.3) -> Column:
    """Weighted sum of two scores, held to [-1, 1]."""
    return clip(_col(a) * wa + _col(b) * wb, -1.0, 1.0)


def range_norm(high: Column | str, low: Column | str, close: Column | str) -> Column:
    return F.try_divide(_col(high) - _col(low), null_if_zero(close))


def box_cox(c: Column | str, lam: Column | float) -> Column:
    """Power transform of positive values; ``lam`` may be a column, such as the exponent found for each series."""
    c = _col(c)
    k = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(k == 0, F.log(c)).otherwise(F.try_divide(F.pow(c, k) - 1.0, k))


def inv_box_cox(c: Column | str, lam: Column | float) -> Column:
    c = _col(c)
    k = lam if isinstance(lam, Column) else F.lit(float(lam))
    power = F.pow(k * c + 1.0, F.try_divide(F.lit(1.0), k))
    return F.when(k == 0, F.exp(c)).otherwise(power)


def _percent(c: Column) -> Column:
    # least and greatest pass over nulls, so an unknown value is kept apart
    whole = F.greatest(F.lit(0), F.least(F.lit(100), c.cast("int")))
    return F.when(c.isNotNull(), whole)


def score_percent(c: Column | str) -> Column:
    """Score in [-1, 1] to a whole percentage."""
    return _percent((_col(c) + 1) * 50)


def confidence_percent(c: Column | str) -> Column:
    """Confidence to a whole percentage; 50 when unknown."""
    return F.coalesce(_percent(_col(c) * 100), F.lit(50))


def label_by(c: Column | str, cut: float) -> Column:
    c = _col(c)
    return F.when(c > cut, "POSITIVE").when(c < -cut, "NEGATIVE").otherwise("NEUTRAL")

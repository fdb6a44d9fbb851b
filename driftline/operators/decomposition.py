"""Additive seasonal decomposition, seasonality strength and residual verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from driftline.functions.temporal import LAG_CANDIDATES
from driftline.operators.correlogram import acf, chi2_tail, ljung_box_q
from driftline.operators.ordered import Series, number_rows, over_series
from driftline.session import join_same, pin, settle

# Thresholds of the verdicts.
STRONG_VAR, STRONG_ACF = 0.02, 0.2
WEAK_VAR, WEAK_ACF = 0.01, 0.10
DEVIATION_VAR, DEVIATION_ACF = 0.01, 0.10
SIMILAR_SHARE, DEVIATING_SHARE = 0.25, 0.6
MIN_RESIDUALS = 50
FLAT_STD = 1e-8


def centred_trend(col: str, period: int, w: WindowSpec) -> Column:
    """Moving average over one period, with half weights at both ends for an even period."""
    half = period // 2
    x = F.col(col)
    frame = w.rowsBetween(-half, half)
    total = F.sum(x).over(frame)
    if period % 2 == 0:
        total = total - 0.5 * (F.lag(x, half).over(w) + F.lead(x, half).over(w))
    return F.when(F.count(x).over(frame) == 2 * half + 1, total / period)


def seasonal_decompose(df: DataFrame, series: Series, col: str, period: int, split: bool | None = None) -> DataFrame:
    """Add trend, seasonal and resid. Rows without a value are dropped first; short series (< 2 periods) are left out."""
    keys = list(series.keys)
    rows = number_rows(df.where(F.col(col).isNotNull()), series, split=split).where(F.col("n_rows") >= 2 * period)
    reach = period // 2
    out = over_series(rows, series, lambda w: {"trend": centred_trend(col, period, w)}, back=reach, ahead=reach, split=split)
    out = settle(out.withColumn("_pos", (F.col("row_no") - 1) % period))
    means = out.groupBy(*keys, "_pos").agg(F.avg(F.col(col) - F.col("trend")).alias("_m"))
    level = F.avg("_m").over(Window.partitionBy(*keys))
    # one row per series and position
    pattern = pin(means.withColumn("seasonal", F.col("_m") - level).select(*keys, "_pos", "seasonal"))
    out = join_same(out, pattern, [*keys, "_pos"])
    return out.withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal")).drop("_pos", "n_rows")


def seasonality_strength(
    decomposed: DataFrame,
    series: Series,
    col: str,
    period: int,
    var_cut: float = STRONG_VAR,
    acf_cut: float = STRONG_ACF,
    split: bool | None = None,
) -> DataFrame:
    """Variance share of the seasonal part and autocorrelation at the period; strong when both reach their cut."""
    keys = list(series.keys)
    known = decomposed.where(F.col("seasonal").isNotNull())
    share = known.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.coalesce(F.try_divide(F.var_pop("seasonal"), F.var_pop(col)), F.lit(0.0)).alias("_share"),
    )
    rho = acf(known, series, col, [period], split).select(*keys, "acf")
    enough = F.col("n") >= max(10, 2 * period)
    out = join_same(share, rho, keys, "left").select(
        *keys,
        "n",
        F.when(enough, F.col("_share")).alias("var_ratio"),
        F.when(enough, F.col("acf")).alias("acf_at_period"),
    )
    strong = (F.col("var_ratio") >= var_cut) & (F.col("acf_at_period") >= acf_cut)
    return out.withColumn("strong", F.coalesce(strong, F.lit(False)).cast("int"))


def strategy_choice(whole: DataFrame, regimes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """global / per_regime / mixed from the strength of the whole series and of its regimes."""
    g = whole.select(*keys, F.col("var_ratio").alias("_gv"), F.col("acf_at_period").alias("_ga"))
    r = regimes.where(F.col("var_ratio").isNotNull()).select(*keys, "var_ratio", "acf_at_period")
    joined = join_same(g, r, keys, "left")
    far_v = F.abs(F.col("var_ratio") - F.col("_gv")) > DEVIATION_VAR
    far_a = F.abs(F.col("acf_at_period") - F.col("_ga")) > DEVIATION_ACF
    shares = joined.groupBy(*keys, "_gv", "_ga").agg(
        F.count("var_ratio").alias("n_regimes"),
        F.avg(far_v.cast("double")).alias("frac_var"),
        F.avg(far_a.cast("double")).alias("frac_acf"),
    )
    weak = (F.col("_gv") < WEAK_VAR) & (F.abs(F.col("_ga")) < WEAK_ACF)
    alike = (F.col("frac_var") < SIMILAR_SHARE) & (F.col("frac_acf") < SIMILAR_SHARE)
    apart = (F.col("frac_var") > DEVIATING_SHARE) | (F.col("frac_acf") > DEVIATING_SHARE)
    pick = (
        F.when(F.col("n_regimes") == 0, "global")
        .when(weak & alike, "global")
        .when(apart, "per_regime")
        .otherwise("mixed")
    )
    return shares.select(*keys, "n_regimes", "frac_var", "frac_acf", pick.alias("strategy"))


def residual_diagnostics(
    df: DataFrame, series: Series, col: str, period: int, granularity: str, split: bool | None = None
) -> DataFrame:
    """Trend, periodicity, centring, whiteness and volatility verdicts per series of at least 50 residuals."""
    keys = list(series.keys)
    rows = number_rows(df.where(F.col(col).isNotNull()), series, split=split).where(F.col("n_rows") >= MIN_RESIDUALS)
    rows = settle(rows.withColumn("_abs", F.abs(F.col(col))))
    basic = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_slope(F.col(col), F.col("row_no").cast("double")).alias("slope"),
        F.avg(col).alias("mean"),
        F.stddev_pop(col).alias("_sp"),
        F.stddev_samp(col).alias("_ss"),
    )
    wanted = list(LAG_CANDIDATES.get(granularity, [])) or [2]
    reach = max(max(10, 2 * period) if 2 * period < 80 else 80, *wanted)
    rho = pin(acf(rows, series, col, range(1, reach + 1), split))
    nlags = F.least(F.lit(max(10, 2 * period)), F.lit(80), F.col("n") - 2)
    peak = (
        rho.where(F.col("lag") <= nlags)
        .groupBy(*keys)
        .agg(F.max(F.abs("acf")).alias("max_acf"), F.min_by("lag", F.struct(-F.abs("acf"), "lag")).alias("max_acf_lag"))
    )

    def portmanteau(r: DataFrame, name: str) -> DataFrame:
        q = ljung_box_q(r, keys, wanted).withColumn("_p", chi2_tail(F.col("q_stat"), F.col("lag")))
        return q.groupBy(*keys).agg(F.min("_p").alias(name))

    raw = portmanteau(rho, "lb_min_p")
    volatile = portmanteau(acf(rows, series, "_abs", range(1, max(wanted) + 1), split), "lb_abs_min_p")
    out = basic
    for part in (peak, raw, volatile):
        out = join_same(out, part, keys, "left")
    flat = F.col("_sp") < FLAT_STD
    return out.select(
        *keys,
        "n",
        "slope",
        "mean",
        "max_acf",
        "max_acf_lag",
        "lb_min_p",
        "lb_abs_min_p",
        (flat | (F.abs("slope") < F.greatest(F.col("_sp") * 0.01, F.lit(1e-6)))).cast("int").alias("no_trend"),
        (flat | F.col("max_acf").isNull() | (F.col("max_acf") < 0.3)).cast("int").alias("no_period"),
        (F.abs("mean") < F.greatest(F.col("_ss") * 0.05, F.lit(1e-6))).cast("int").alias("centred"),
        (flat | (F.col("lb_min_p") > 0.05)).cast("int").alias("white_noise"),
        (~flat & (F.col("lb_abs_min_p") <= 0.05)).cast("int").alias("volatility_effect"),
    )

"""Maximum-likelihood Box-Cox exponent per series, by a grid that is narrowed around the best value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.numeric import box_cox
from driftline.session import join_same, pin, settle

GRID = [round(-3.0 + 0.25 * i, 2) for i in range(25)]


def _transform(y: Column, lam: Column) -> Column:
    return F.when(F.abs(lam) < 1e-9, F.log(y)).otherwise((F.pow(y, lam) - 1.0) / lam)


def boxcox_by_series(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Add ``out``, the transform of ``col`` with the exponent of its series, and ``lam`` to undo it later."""
    df = settle(df)
    lams = pin(boxcox_lambda(df, keys, col).select(*keys, "lam"))
    return join_same(df, lams, list(keys), "left").withColumn(out, box_cox(col, F.col("lam")))


def boxcox_lambda(df: DataFrame, keys: Sequence[str], col: str, rounds: int = 4) -> DataFrame:
    """``lam`` to about 1e-3 with advice; series with a value <= 0 get null and "not_applicable".

    Values are divided by their geometric mean, which leaves the exponent unchanged and the likelihood a plain
    function of one variance. Every round is one aggregate over all series.
    """
    keys = list(keys)
    x = F.col(col).cast("double")
    known = settle(df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull()))
    base = pin(
        known.groupBy(*keys).agg(
            F.count("*").alias("n"),
            F.min("_x").alias("_min"),
            F.avg(F.log(F.when(F.col("_x") > 0, F.col("_x")))).alias("_log"),
        )
    )
    usable = base.where("_min > 0")
    scaled = join_same(known, usable, keys).withColumn("_y", F.exp(F.log("_x") - F.col("_log")))
    step, grid = 0.25, F.array(*[F.lit(v) for v in GRID])
    at = None
    for _ in range(rounds):
        if at is None:
            rows = scaled.withColumn("_lam", F.explode(grid))
        else:
            around = F.transform(F.sequence(F.lit(-10), F.lit(10)), lambda i: F.col("_best") + i * F.lit(step))
            rows = join_same(scaled, at.select(*keys, "_best"), keys).withColumn("_lam", F.explode(around))
        fit = rows.groupBy(*keys, "n", "_lam").agg(F.var_pop(_transform(F.col("_y"), F.col("_lam"))).alias("_var"))
        fit = fit.withColumn("_ll", -F.col("n") / 2 * F.log("_var"))
        w = Window.partitionBy(*keys).orderBy("_lam")
        # peak of the parabola through the best grid point and its neighbours
        a, b, c = F.lag("_ll").over(w), F.col("_ll"), F.lead("_ll").over(w)
        bend = a - 2 * b + c
        shift = F.coalesce(F.try_divide(0.5 * (a - c), bend), F.lit(0.0)) * F.lit(step)
        held = F.greatest(F.lit(-step), F.least(F.lit(step), shift))
        peak = fit.withColumn("_peak", F.col("_lam") + held)
        at = pin(peak.groupBy(*keys).agg(F.max_by("_peak", "_ll").alias("_best")))
        step /= 8
    lam = F.col("_best")
    advice = (
        F.when(lam.isNull(), "not_applicable")
        .when(F.abs(lam - 1) < 0.2, "keep")
        .when(F.abs(lam) < 0.2, "log")
        .otherwise("power")
    )
    return join_same(base, at, keys, "left").select(
        *keys,
        "n",
        F.round(lam, 3).alias("lam"),
        advice.alias("recommendation"),
        F.when(lam.isNull(), "non_positive").otherwise("ok").alias("note"),
    )

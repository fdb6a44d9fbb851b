"""Exact quantiles without holding a group in one task.

A mergeable sketch brackets every wanted rank; a second pass counts the rows below each bracket and tallies the
distinct values inside it, so that only the thin bracket is ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.ordered import running_total
from driftline.session import join_same, pin, settle

ACCURACY = 10_000
PARTS = 4096


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per key with ``n`` and ``q`` (array in the order of ``probs``), linearly interpolated between ranks.

    The sketch is off by at most n / ``accuracy`` ranks, so a bracket of three times that holds the exact values.
    Groups below five times ``accuracy`` rows are ranked whole.
    """
    small_group = 5 * accuracy
    data = settle(df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull()))
    slack = 3.0 / accuracy
    cuts = [c for p in probs for c in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = data.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.percentile_approx("_x", [float(c) for c in cuts], accuracy).alias("_cuts"),
    )
    brackets = pin(
        sketch.select(
            *keys,
            "n",
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("i"),
                        _bound(2 * i, float("-inf"), p - slack <= 0, small_group).alias("lo"),
                        _bound(2 * i + 1, float("inf"), p + slack >= 1, small_group).alias("hi"),
                    )
                    for i, p in enumerate(probs)
                ]
            ).alias("_b"),
        ),
    )
    lo, hi = F.col("_p.lo"), F.col("_p.hi")
    under = F.col("_x") < lo
    # position inside the bracket; -1 gathers all rows below it, open brackets are small groups
    share = F.floor(F.try_divide(F.col("_x") - lo, hi - lo) * PARTS)
    part = F.when(under, -1).when((hi - lo) < float("inf"), F.coalesce(share, F.lit(0))).otherwise(0)
    placed = (
        _join(data, brackets, keys)
        .withColumn("_p", F.explode("_b"))
        .where(F.col("_x") <= hi)
        .select(
            *keys,
            "n",
            F.col("_p.i").alias("_i"),
            part.cast("long").alias("_part"),
            F.when(under, F.lit(float("-inf"))).otherwise(F.col("_x")).alias("_v"),
        )
    )
    tally = placed.groupBy(*keys, "n", "_i", "_part", "_v").agg(F.count("*").alias("_c"))
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1)
    ranked = running_total(tally, [*keys, "_i"], "_part", "_v", "_c", "_end").withColumn(
        "_pos", prob * (F.col("n") - 1)
    )
    points = (
        ranked.groupBy(*keys, "n", "_i", "_pos")
        .agg(
            F.min(F.when(F.col("_end") > F.floor("_pos"), F.col("_v"))).alias("_lo"),
            F.min(F.when(F.col("_end") > F.ceil("_pos"), F.col("_v"))).alias("_hi"),
        )
        .withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos")))
    )
    return points.groupBy(*keys, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias("q")
    )


def _bound(index: int, open_end: float, is_open: bool, small_group: int) -> Column:
    if is_open:
        return F.lit(open_end)
    return F.when(F.col("n") < small_group, F.lit(open_end)).otherwise(F.col("_cuts")[index])


def _join(df: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return join_same(df, brackets, keys)
    # one row on the right
    return df.join(brackets, F.lit(True))


def one_quantile(df: DataFrame, value: str, prob: float, default: float) -> DataFrame:
    """A single row with ``q``, or ``default`` when there is no value."""
    got = exact_quantiles(df, [], value, [prob]).select(F.col("q")[0].alias("q"))
    return got.agg(F.coalesce(F.max("q"), F.lit(float(default))).alias("q"))

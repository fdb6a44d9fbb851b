"""Autocorrelation of many series at once, and what is read off it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from driftline.functions.temporal import PERIOD_CANDIDATES, safe_lag
from driftline.operators.ordered import CHUNK, HALO, Series, framed_chunks
from driftline.operators.rolling import difference
from driftline.session import join_same, pin, settle

# Significance width, thresholds and size rules.
Z95 = 1.96
PERIOD_ACF = 0.02
PERIOD_LAG_CAP = 2000
MIN_ORDER_ROWS = 30
# rows a transform takes at least
FFT_ROWS = 1 << 16


def lag_products(v: np.ndarray, first: int, lags: np.ndarray, block: int = FFT_ROWS) -> np.ndarray:
    """Sum of v[t] * v[t - k] over t >= first, per lag k; rows before the start of ``v`` count as zero.

    Overlap-save: every block of rows is correlated with itself and the largest lag in front of it through one
    transform, so memory is set by the block and the largest lag, and time hardly grows with the number of lags.
    """
    reach = int(lags.max())
    block = max(block, reach)
    out = np.zeros(len(lags))
    for start in range(first, len(v), block):
        now = v[start : start + block]
        past = v[max(0, start - reach) : start + len(now)]
        lead = len(past) - len(now)
        size = 1 << (len(past) + len(now)).bit_length()
        # at shift s: sum of now[i] * past[i + s], and lag k is the shift lead - k
        cross = np.fft.irfft(np.fft.rfft(past, size) * np.conj(np.fft.rfft(now, size)), size)
        out += cross[(lead - lags) % size]
    return out


def _sums_in_chunks(known: DataFrame, means: DataFrame, series: Series, lags: list[int], split: bool | None, **kw) -> DataFrame:
    keys, order = list(series.keys), list(dict.fromkeys((series.ts, *series.tie)))
    framed = framed_chunks(known, series, max(lags), split, **kw)
    x = join_same(framed, means, keys).select(*keys, CHUNK, HALO, *order, (F.col("_v") - F.col("_mean")).alias("_x"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.select(*keys).schema.fields)
    steps = np.array([0, *lags])

    def reduce(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        v = pdf["_x"].to_numpy(dtype=float)
        own = np.flatnonzero(~pdf[HALO].to_numpy(dtype=bool))
        first, last = int(own[0]), int(own[-1]) + 1  # own rows are contiguous
        v = v[:last]
        through = np.concatenate([[0.0], np.cumsum(v)])
        start = np.maximum(first, steps)  # the rows in front are all there are, or reach far enough
        met = start < last
        k, start = steps[met], start[met]
        sums = through[last] - through[start] + through[last - k] - through[start - k]
        found = {"lag": k, "_c": last - start, "_xy": lag_products(v, first, k), "_s": sums}
        return pd.DataFrame({**{c: [g] * len(k) for c, g in zip(keys, group)}, **found})

    parts = x.groupBy(*keys, CHUNK).applyInPandas(reduce, f"{key_schema}, lag int, _c long, _xy double, _s double")
    return parts.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("_c", "_xy", "_s")])


def acf(df: DataFrame, series: Series, col: str, lags: Sequence[int], split: bool | None = None, **kw) -> DataFrame:
    """Biased autocorrelation per (series, lag) for lags >= 1, with the series length ``n``.

    Values are centred first, so products keep their digits. Products of all lags come from one transform per block
    of rows of each (series, chunk); only the sums meet afterwards. A null key is a series of its own.
    """
    keys = list(series.keys)
    lags = sorted({int(k) for k in lags if k >= 1})
    known = df.where(F.col(col).isNotNull()).select(
        *keys, *dict.fromkeys((series.ts, *series.tie)), F.col(col).cast("double").alias("_v")
    )
    # read for the means and for the chunks
    known = settle(known)
    means = pin(known.groupBy(*keys).agg(F.avg("_v").alias("_mean")))
    sums = _sums_in_chunks(known, means, series, lags, split, **kw)
    # one row per lag and series, so the row of lag 0 is handed over in place
    zero = F.max(F.when(F.col("lag") == 0, F.struct("_c", "_xy", "_s"))).over(Window.partitionBy(*keys))
    n, total = F.col("_z._c"), F.col("_z._s") / 2
    mean = total / n
    top = F.col("_xy") - mean * F.col("_s") + F.col("_c") * mean * mean
    bottom = F.col("_z._xy") - n * mean * mean
    return (
        sums.withColumn("_z", zero)
        .where("lag > 0")
        .select(*keys, "lag", F.try_divide(top, bottom).alias("acf"), n.alias("n"))
    )


@F.pandas_udf(ArrayType(DoubleType()))
def _levinson(rhos: pd.Series) -> pd.Series:
    """Partial autocorrelations 1..K from autocorrelations 1..K (Yule-Walker recursion)."""

    def one(r) -> list[float]:
        r = np.concatenate([[1.0], np.asarray(r, dtype=float)])
        phi, err, out = np.zeros(0), 1.0, []
        for k in range(1, len(r)):
            reflection = (r[k] - phi @ r[k - 1 : 0 : -1]) / err if err > 0 else np.nan
            phi = np.concatenate([phi - reflection * phi[::-1], [reflection]])
            err *= 1.0 - reflection**2
            out.append(float(reflection))
        return out

    return rhos.map(one)


def pacf(acf_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial autocorrelation per (series, lag); needs every lag from 1 up."""
    vectors = acf_rows.groupBy(*keys, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("_r")
    )
    return vectors.select(*keys, "n", F.posexplode(_levinson("_r")).alias("_i", "pacf")).select(
        *keys, (F.col("_i") + 1).alias("lag"), "pacf", "n"
    )


def significant(value: Column, n: Column) -> Column:
    return F.abs(value) > Z95 / F.sqrt(n)


def suggested_orders(acf_rows: DataFrame, pacf_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First significant lag of the acf is q, of the pacf is p; 0 when there is none or the series is short."""
    enough = F.col("n") >= MIN_ORDER_ROWS
    q = acf_rows.groupBy(*keys).agg(F.min(F.when(enough & significant(F.col("acf"), F.col("n")), F.col("lag"))).alias("q"))
    p = pacf_rows.groupBy(*keys).agg(F.min(F.when(enough & significant(F.col("pacf"), F.col("n")), F.col("lag"))).alias("p"))
    return join_same(q, p, keys).select(*keys, F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("q", F.lit(0)).alias("q"))


def seasonal_orders(acf_rows: DataFrame, pacf_rows: DataFrame, keys: Sequence[str], period: int) -> DataFrame:
    """``sq`` and ``sp`` are 1 when any multiple of the period is significant, on series of at least max(60, 5m) rows."""
    usable = (F.col("lag") % period == 0) & (F.col("n") >= max(60, 5 * period))
    q = acf_rows.groupBy(*keys).agg(F.max((usable & significant(F.col("acf"), F.col("n"))).cast("int")).alias("sq"))
    p = pacf_rows.groupBy(*keys).agg(F.max((usable & significant(F.col("pacf"), F.col("n"))).cast("int")).alias("sp"))
    return join_same(q, p, keys).select(*keys, "sp", "sq")


def suggest_orders(
    df: DataFrame,
    series: Series,
    col: str,
    orders: DataFrame,
    granularity: str,
    period: int = 0,
    split: bool | None = None,
) -> DataFrame:
    """``orders`` (keys, d, sd) with p, q, sp and sq suggested by the correlograms of the differenced values.

    Plain orders look at lags up to the safe lag of the granularity, seasonal ones at multiples of the period up to
    max(2 * period, 60), at most 400, on values that are differenced at the period as well where ``sd`` says so.
    """
    keys = list(series.keys)
    orders = pin(orders.select(*keys, "d", "sd"))
    wide = min(max(2 * period, 60), 400) if period > 1 else 0
    df = settle(df)

    def differenced(seasonal: bool) -> DataFrame:
        part = None
        wanted = orders.select("d", F.col("sd") if seasonal else F.lit(0).alias("sd")).distinct().collect()
        for d, sd in sorted((r["d"], r["sd"]) for r in wanted):  # a handful of orders
            same = orders.where((F.col("d") == d) & (F.col("sd") == sd if seasonal else F.lit(True)))
            got = difference(join_same(df, same, keys, "left_semi"), series, col, d=d, seasonal=sd, period=max(period, 1), out="_w", split=split)
            part = got if part is None else part.unionByName(got)
        return part

    found = orders
    for seasonal in (False, True)[: 2 if wide else 1]:
        part = differenced(seasonal)
        if part is None:
            break
        longest = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        limit = F.least(F.lit(wide), F.col("n") - 2) if seasonal else safe_lag(granularity, period, F.col("n"))
        top = part.sparkSession.createDataFrame([(longest,)], "n bigint").select(limit.alias("k")).first()["k"]
        rho = settle(acf(part, series, "_w", range(1, max(1, top) + 1), split).where(F.col("lag") <= limit))
        partial = pacf(rho, keys)
        pairs = seasonal_orders(rho, partial, keys, period) if seasonal else suggested_orders(rho, partial, keys)
        found = join_same(found, pairs, keys, "left")
    known = set(found.columns)
    return found.select(*keys, *[(F.coalesce(c, F.lit(0)) if c in known else F.lit(0)).cast("int").alias(c) for c in ("p", "q", "sp", "sq", "d", "sd")])


def infer_period(
    df: DataFrame,
    series: Series,
    col: str,
    granularity: str,
    manual: int | None = None,
    threshold: float = PERIOD_ACF,
    split: bool | None = None,
) -> DataFrame:
    """Seasonal period per series: the manual one, else the candidate lag with the largest autocorrelation of the
    differences, else the first candidate."""
    keys = list(series.keys)
    candidates = PERIOD_CANDIDATES.get(granularity)
    if not candidates:
        raise ValueError(f"no period candidates for granularity {granularity!r}")
    if manual is not None:
        return df.select(*keys).distinct().select(*keys, F.lit(manual).alias("period"), F.lit("manual").alias("source"))
    max_lag = min(max(2 * max(candidates), 50), PERIOD_LAG_CAP)
    steps = difference(df, series, col, d=1, out="_d", split=split)
    rho = acf(steps, series, "_d", candidates, split)
    best = rho.groupBy(*keys, "n").agg(
        F.max_by("lag", F.struct("acf", -F.col("lag"))).alias("_m"), F.max("acf").alias("_r")
    )
    accepted = (F.col("n") >= max_lag + 5) & (F.col("_r") >= F.greatest(F.lit(threshold), Z95 / F.sqrt("n")))
    every = join_same(df.select(*keys).distinct(), best, keys, "left")
    return every.select(
        *keys,
        F.when(accepted, F.col("_m")).otherwise(F.lit(candidates[0])).alias("period"),
        F.when(accepted, "acf").otherwise("first_candidate").alias("source"),
    )


def _chi2_tail(x: float, k: int) -> float:
    """P(chi-square with k degrees of freedom > x), by its finite series."""
    if x is None or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    half = x / 2.0
    if k % 2 == 0:
        terms = [i * math.log(half) - math.lgamma(i + 1) - half for i in range(k // 2)]
        return min(1.0, math.fsum(math.exp(t) for t in terms))
    terms = [(i - 0.5) * math.log(half) - math.lgamma(i + 0.5) - half for i in range(1, (k + 1) // 2)]
    return min(1.0, math.erfc(math.sqrt(half)) + math.fsum(math.exp(t) for t in terms))


@F.pandas_udf(DoubleType())
def chi2_tail(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for x, k in batches:
        yield pd.Series([_chi2_tail(a, int(b)) for a, b in zip(x, k)], dtype="float64")


def ljung_box_q(acf_rows: DataFrame, keys: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Q statistic per (series, lag); ``acf_rows`` must hold every lag up to the largest."""
    at = F.explode(F.array(*[F.lit(int(k)) for k in lags]))
    term = F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag"))
    return (
        acf_rows.withColumn("_L", at)
        .where((F.col("lag") <= F.col("_L")) & (F.col("_L") >= 2) & (F.col("_L") < F.col("n") - 2))
        .groupBy(*keys, "n", "_L")
        .agg(F.sum(term).alias("_t"))
        .select(*keys, F.col("_L").alias("lag"), "n", (F.col("n") * (F.col("n") + 2) * F.col("_t")).alias("q_stat"))
    )


def ljung_box(df: DataFrame, series: Series, col: str, lags: Sequence[int], split: bool | None = None) -> DataFrame:
    rho = acf(df, series, col, range(1, max(lags) + 1), split)
    q = ljung_box_q(rho, series.keys, lags)
    return q.withColumn("p_value", chi2_tail(F.col("q_stat"), F.col("lag")))

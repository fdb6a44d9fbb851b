"""Joins in time: nearest, backward, exact-then-fill, regime ranges, model merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.temporal import epoch_us
from driftline.operators.ordered import CHUNK_ROWS, CHUNK_SECONDS, Series, carry
from driftline.session import broadcast_if_small, join_same


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    take: Sequence[str],
    direction: str = "nearest",
    tie: str = "later",
    tolerance_s: float | None = None,
    left_tie: Sequence[str] = (),
    right_tie: Sequence[str] = (),
    prefix: str = "r_",
    strict: bool = False,
    split: bool | None = None,
    rows_per_chunk: int = CHUNK_ROWS,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Attach to every left row the right row of the same key closest in time.

    Both sides are stacked and one ordered pass carries the last right row seen forwards and backwards, so the
    shuffle is on (key, time chunk) and no pair is ever enumerated. Ties are whole numbers. ``direction`` is nearest, backward or forward;
    an equal distance goes to the ``tie`` side. Outside ``tolerance_s`` the match is null; ``strict`` raises instead.
    Adds ``prefix`` + right_ts, the ``take`` columns and ``delta_s``.
    """
    if direction not in ("nearest", "backward", "forward") or tie not in ("later", "earlier"):
        raise ValueError("direction is nearest, backward or forward; tie is later or earlier")
    keys = list(keys)
    cols = list(left.columns)
    payload = [right_ts, *[c for c in take if c != right_ts]]
    hit_type = right.select(F.struct(*payload).alias("h")).schema["h"].dataType
    pad = max(len(left_tie), len(right_tie))

    def ranked(side: int, names: Sequence[str]) -> Column:
        parts = [F.col(c).cast("long") for c in names] + [F.lit(0).cast("long")] * (pad - len(names))
        return F.struct(F.lit(side).alias("s"), *[p.alias(f"t{i}") for i, p in enumerate(parts)])

    lrows = left.where(F.col(left_ts).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(left_ts).alias("_t"),
        ranked(1, left_tie).alias("_o"),
        ranked(0, left_tie).alias("_b"),
        F.struct(*cols).alias("_row"),
        F.lit(None).cast(hit_type).alias("_hit"),
    )
    rrows = right.where(F.col(right_ts).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(right_ts).cast(dict(left.dtypes)[left_ts]).alias("_t"),
        ranked(0, right_tie).alias("_o"),
        ranked(1, right_tie).alias("_b"),
        F.lit(None).cast(left.select(F.struct(*cols).alias("x")).schema["x"].dataType).alias("_row"),
        F.struct(*payload).alias("_hit"),
    )
    stacked = lrows.unionByName(rrows)
    key_cols = tuple(f"_k{i}" for i in range(len(keys)))
    if not key_cols:
        stacked, key_cols = stacked.withColumn("_k0", F.lit(0)), ("_k0",)
    # read forwards, a right row comes before a left row of the same time; read backwards likewise
    series = Series(key_cols, "_t", ("_o",), chunk_seconds, back_tie=("_b",))
    stacked = carry(
        stacked,
        series,
        last={} if direction == "forward" else {"_back": "_hit"},
        following={} if direction == "backward" else {"_fwd": "_hit"},
        split=split,
        rows_per_chunk=rows_per_chunk,
    )
    out = stacked.where(F.col("_row").isNotNull())
    t = epoch_us("_t")
    if direction == "backward":
        best = F.col("_back")
    elif direction == "forward":
        best = F.col("_fwd")
    else:
        back_gap = t - epoch_us(F.col(f"_back.{right_ts}"))
        fwd_gap = epoch_us(F.col(f"_fwd.{right_ts}")) - t
        ahead = fwd_gap <= back_gap if tie == "later" else fwd_gap < back_gap
        best = F.when(F.col("_back").isNull() | ahead, F.col("_fwd")).otherwise(F.col("_back"))
    out = out.withColumn("_best", best)
    gap = F.abs(epoch_us(F.col(f"_best.{right_ts}")) - t) / F.lit(1_000_000.0)
    if tolerance_s is not None:
        near = gap <= tolerance_s
        if strict:
            near = near | F.raise_error(F.lit("no row within the tolerance")).cast("boolean")
        out = out.withColumn("_best", F.when(near, F.col("_best")))
    return out.select(
        "_row.*",
        *[F.col(f"_best.{c}").alias(f"{prefix}{c}") for c in payload],
        gap.alias("delta_s"),
    )


def exact_else_nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, take, **kw):
    """Equality wins (distance 0); otherwise the nearest row, earlier on a tie."""
    joined = asof_join(left, right, keys, left_ts, right_ts, take, tie="earlier", **kw)
    return joined.withColumn("exact", (F.col("delta_s") == 0).cast("int"))


def fill_from_index(
    features: DataFrame,
    index: DataFrame,
    series: Series,
    index_ts: str,
    index_value: str,
    out: str,
    default: float = 50.0,
    split: bool | None = None,
) -> DataFrame:
    """Equality on the bucket time, then the last value met along the feature rows, then the default."""
    daily = index.select(F.col(index_ts).alias(series.ts), F.col(index_value).cast("double").alias("_ix"))
    met = features.join(broadcast_if_small(daily), series.ts, "left")
    filled = carry(met, series, last={out: "_ix"}, split=split)
    return filled.withColumn(out, F.coalesce(F.col(out), F.lit(float(default)))).drop("_ix")


def index_asof(features: DataFrame, index: DataFrame, ts: str, index_ts: str, index_value: str, out: str, default=50.0):
    """The index value known at each bucket, also when its own bucket is absent."""
    got = asof_join(features, index, [], ts, index_ts, [index_value], direction="backward")
    return got.withColumn(out, F.coalesce(F.col(f"r_{index_value}").cast("double"), F.lit(float(default)))).drop(
        f"r_{index_ts}", f"r_{index_value}", "delta_s"
    )


def merge_models(a: DataFrame, b: DataFrame, on: Sequence[str], a_name: str, b_name: str) -> DataFrame:
    """Full outer merge of two prediction tables with one ``y_true``."""
    left = a.select(*on, F.col("y_pred").alias(f"y_pred_{a_name}"), F.col("y_true").alias("_ya"))
    right = b.select(*on, F.col("y_pred").alias(f"y_pred_{b_name}"), F.col("y_true").alias("_yb"))
    return left.join(right, list(on), "full_outer").select(
        *on, f"y_pred_{a_name}", f"y_pred_{b_name}", F.coalesce("_ya", "_yb").alias("y_true")
    )


def agreement(merged: DataFrame, a: str, b: str) -> DataFrame:
    """Both models present; ``agree`` is 1 when they say the same."""
    return merged.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn(
        "agree", (F.col(a) == F.col(b)).cast("int")
    )


def base_price(
    targets: DataFrame, candles: DataFrame, points: DataFrame, keys: Sequence[str], target_ts: str, hours: int, **kw
) -> DataFrame:
    """Close exactly ``hours`` before the target, else the last close up to it, else the last known price."""
    keys = list(keys)
    exact = candles.select(
        *keys, (F.col("ts") + F.expr(f"INTERVAL '{hours}' HOUR")).alias(target_ts), F.col("close").alias("_exact")
    )
    out = join_same(targets, exact, [*keys, target_ts], "left")
    out = asof_join(out, candles, keys, target_ts, "ts", ["close"], direction="backward", prefix="_c_", **kw)
    out = out.drop("delta_s", "_c_ts")
    known = points.where(F.col("price").isNotNull())
    out = asof_join(out, known, keys, target_ts, "ts", ["price"], direction="backward", prefix="_p_", **kw)
    return out.withColumn("base_price", F.coalesce("_exact", "_c_close", "_p_price")).drop(
        "delta_s", "_p_ts", "_p_price", "_c_close", "_exact"
    )


def assign_regime(
    df: DataFrame,
    ts: str,
    edges: Sequence[str],
    bounds: tuple[str, str] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Number the segment between consecutive edges that a row falls in; rows are matched without a join.

    Edges outside the data range are ignored, the data range closes the outer segments. Segments are half-open
    unless ``inclusive``, where a row on an inner edge belongs to both neighbours.
    """
    kind = dict(df.dtypes)[ts]
    if bounds is None:
        row = df.agg(F.min(ts).cast("string").alias("lo"), F.max(ts).cast("string").alias("hi")).first()
        bounds = (row["lo"], row["hi"])
    marks = [F.lit(e).cast(kind) for e in sorted(edges)]
    lo, hi = (F.lit(b).cast(kind) for b in bounds)
    inner = F.filter(F.array(*marks), lambda e: (e > lo) & (e < hi))
    cuts = F.concat(F.array(lo), inner, F.array(hi))
    segments = F.zip_with(
        F.slice(cuts, F.lit(1), F.size(cuts) - 1),
        F.slice(cuts, F.lit(2), F.size(cuts) - 1),
        lambda a, b: F.struct(a.alias("start"), b.alias("end")),
    )
    numbered = F.transform(segments, lambda s, i: F.struct((i + 1).alias("regime_id"), s["start"].alias("start"), s["end"].alias("end")))
    t = F.col(ts)

    def holds(s: Column) -> Column:
        closed = t <= s["end"] if inclusive else (t < s["end"]) | (s["end"] == hi)
        return (t >= s["start"]) & (t <= hi) & closed

    out = df.withColumn("_r", F.explode(F.filter(numbered, holds)))
    return out.select(
        *df.columns,
        F.col("_r.regime_id").alias("regime_id"),
        F.col("_r.start").alias("regime_start"),
        F.col("_r.end").alias("regime_end"),
    )


def aligned_pairs(actual: DataFrame, forecast: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner match of actual and forecast with both values known."""
    return actual.join(forecast, list(on)).where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())

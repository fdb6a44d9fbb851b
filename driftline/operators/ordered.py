"""Row-ordered work inside a series, split so that no series has to fit one task.

A series is cut into time chunks. Chunks that hold too many rows are cut again. A window function with a bounded
frame then runs inside (series, chunk), after the few rows it needs from the neighbouring chunks ("halo" rows) have
been copied in. Unbounded state (last value seen, row number) travels as one summary row per chunk. The large table
is shuffled once, on (series, chunk).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from driftline.functions.temporal import epoch_us
from driftline.session import join_same, pin, settle

CHUNK = "_chunk"
HALO = "_halo"
CHUNK_ROWS = 2_000_000
# a series starts as one chunk and is cut where it holds too many rows
CHUNK_SECONDS = 100 * 365 * 24 * 3600


@dataclass(frozen=True)
class Series:
    """What identifies a series and how its rows are ordered. ``tie`` makes the order total.

    ``back_tie`` replaces ``tie`` when the series is read backwards.
    """

    keys: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    chunk_seconds: int = CHUNK_SECONDS
    back_tie: tuple[str, ...] | None = None

    def __post_init__(self):
        if not self.keys:
            raise ValueError("a series needs at least one key column")

    def order_columns(self, descending: bool = False) -> tuple[str, ...]:
        tie = self.back_tie if descending and self.back_tie is not None else self.tie
        return (self.ts, *tie)

    def order(self, descending: bool = False) -> list[Column]:
        return [F.col(c).desc() if descending else F.col(c).asc() for c in self.order_columns(descending)]

    def window(self, *extra: str, descending: bool = False) -> WindowSpec:
        return Window.partitionBy(*self.keys, *extra).orderBy(*self.order(descending))


def should_split(df: DataFrame, split: bool | None) -> bool:
    """Split unless the caller, who knows a bound on the rows of a series, says otherwise."""
    return True if split is None else split


def assign_chunks(df: DataFrame, series: Series, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add the start (epoch microseconds) of each row's chunk.

    Every round counts rows per chunk and cuts the ones above ``rows_per_chunk`` into equal spans of the times that
    occur, until none is crowded but for single instants. The table of such chunks has at most total rows / ``rows_per_chunk`` entries.
    The input is read several times from here on, so anything but a plain scan is settled first. A whole number may
    stand for the time.
    """
    df = settle(df)
    width = series.chunk_seconds * 1_000_000
    us = F.col(series.ts).cast("long") if dict(df.dtypes)[series.ts] in ("int", "bigint") else epoch_us(series.ts)
    out = df.withColumn(CHUNK, us - F.pmod(us, F.lit(width)))
    by = [*series.keys, CHUNK]
    while True:
        sizes = [F.count("*").alias("_rows"), F.min(us).alias("_lo"), F.max(us).alias("_hi")]
        counts = out.groupBy(*by).agg(*sizes).where("_lo < _hi")
        # most often no chunk is crowded, and one small job says so
        if (counts.agg(F.max("_rows").alias("n")).first()["n"] or 0) <= rows_per_chunk:
            break
        parts = F.ceil(2 * F.col("_rows") / rows_per_chunk)
        # the times that occur are cut, so a burst in a wide chunk needs few rounds
        step = F.ceil((F.col("_hi") - F.col("_lo") + 1) / parts).cast("long").alias("_step")
        crowded = pin(counts.where(F.col("_rows") > rows_per_chunk).select(*by, "_lo", step))
        start = F.when(F.col("_step").isNotNull(), us - F.pmod(us - F.col("_lo"), F.col("_step"))).otherwise(F.col(CHUNK))
        out = join_same(out, crowded, by, "left").withColumn(CHUNK, start).drop("_lo", "_step")
    return out


def _same(by: list[str]) -> Column:
    cond = F.lit(True)
    for c in by:
        cond = cond & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return cond


def _neighbour_rows(df: DataFrame, series: Series, n: int, forward: bool) -> DataFrame:
    """Copies of the rows that later (``forward``) or earlier chunks need: the nearest ``n`` outside each chunk."""
    by = [*series.keys, CHUNK]
    edge = df.withColumn("_e", F.row_number().over(series.window(CHUNK, descending=forward))).where(F.col("_e") <= n)
    along = F.col(CHUNK).asc() if forward else F.col(CHUNK).desc()
    w = Window.partitionBy(*series.keys).orderBy(along)
    targets = (
        edge.groupBy(*by)
        .agg(F.count("*").alias("_n"))
        .withColumn("_through", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "_next",
            F.collect_list(F.struct(F.col(CHUNK).alias("to"), (F.col("_through") - F.col("_n")).alias("before"))).over(
                w.rowsBetween(1, n)
            ),
        )
        .where(F.size("_next") > 0)
        .select(*by, "_through", "_next")
    )
    joined = edge.alias("l").join(targets.alias("r"), _same(by)).select("l.*", "r._through", "r._next")
    reach = F.filter("_next", lambda t: F.col("_e") + t["before"] - F.col("_through") <= n)
    return (
        joined.withColumn("_to", F.explode(reach))
        .withColumn(CHUNK, F.col("_to.to"))
        .drop("_e", "_through", "_next", "_to")
    )


def with_halo(df: DataFrame, series: Series, back: int = 0, ahead: int = 0) -> DataFrame:
    """Own rows plus, flagged, the ``back`` rows before and the ``ahead`` rows after each chunk."""
    out = df.withColumn(HALO, F.lit(False))
    if back:
        out = out.unionByName(_neighbour_rows(df, series, back, True).withColumn(HALO, F.lit(True)))
    if ahead:
        out = out.unionByName(_neighbour_rows(df, series, ahead, False).withColumn(HALO, F.lit(True)))
    return out


def framed_chunks(
    df: DataFrame, series: Series, back: int, split: bool | None, rows_per_chunk: int = CHUNK_ROWS
) -> DataFrame:
    """Chunks with the ``back`` rows before each, for work that takes a whole chunk at a time."""
    if should_split(df, split):
        return with_halo(assign_chunks(df, series, rows_per_chunk), series, back=back)
    return df.withColumns({CHUNK: F.lit(0).cast("long"), HALO: F.lit(False)})


Step = Callable[[WindowSpec], Mapping[str, Column]]


def over_series(
    df: DataFrame,
    series: Series,
    *steps: Step,
    back: int = 0,
    ahead: int = 0,
    split: bool | None = None,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns. Each step maps the ordered window to new columns; later steps see earlier ones.

    ``back`` and ``ahead`` say how many rows the steps reach in total, which must be bounded.
    """
    if not should_split(df, split):
        w = series.window()
        for step in steps:
            df = df.withColumns(dict(step(w)))
        return df
    out = with_halo(assign_chunks(df, series, rows_per_chunk), series, back, ahead)
    w = series.window(CHUNK)
    for step in steps:
        out = out.withColumns(dict(step(w)))
    return out.where(~F.col(HALO)).drop(CHUNK, HALO)


def carry(
    df: DataFrame,
    series: Series,
    last: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    split: bool | None = None,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Fill from the nearest known row, however far away, the current row included.

    ``last`` and ``following`` map new names to source columns: the last non-null value so far and the next one.
    """
    plans = [(True, last or {}), (False, following or {})]
    frame = (Window.unboundedPreceding, 0)
    if not should_split(df, split):
        for forward, columns in plans:
            w = series.window(descending=not forward).rowsBetween(*frame)
            df = df.withColumns({new: F.last(old, ignorenulls=True).over(w) for new, old in columns.items()})
        return df
    by = [*series.keys, CHUNK]
    out = assign_chunks(df, series, rows_per_chunk)
    picks, inbound = [], []
    for forward, columns in plans:
        rank = F.struct(*[F.col(c) for c in series.order_columns(not forward)])
        pick = F.max_by if forward else F.min_by
        along = F.col(CHUNK).asc() if forward else F.col(CHUNK).desc()
        past = Window.partitionBy(*series.keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        for new, old in columns.items():
            picks.append(pick(F.col(old), F.when(F.col(old).isNotNull(), rank)).alias(f"_in_{new}"))
            inbound.append(F.last(f"_in_{new}", ignorenulls=True).over(past).alias(f"_in_{new}"))
    # what enters a chunk from outside is one more row in front of it, so the large side needs no join
    lead = out.groupBy(*by).agg(*picks).select(*by, *inbound, F.lit(True).alias(HALO))
    out = out.withColumn(HALO, F.lit(False)).unionByName(lead, allowMissingColumns=True)
    for forward, columns in plans:
        w = Window.partitionBy(*by).orderBy(F.col(HALO).desc(), *series.order(not forward)).rowsBetween(*frame)
        out = out.withColumns(
            {new: F.last(F.coalesce(F.col(old), F.col(f"_in_{new}")), ignorenulls=True).over(w) for new, old in columns.items()}
        )
    names = [new for _, columns in plans for new in columns]
    return out.where(~F.col(HALO)).drop(CHUNK, HALO, *[f"_in_{new}" for new in names])


def number_rows(
    df: DataFrame,
    series: Series,
    split: bool | None = None,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``row_no`` (from 1, in series order) and ``n_rows`` (rows of the series)."""
    df = df.drop("row_no", "n_rows")
    if not should_split(df, split):
        whole = Window.partitionBy(*series.keys)
        return df.withColumns({"row_no": F.row_number().over(series.window()).cast("long"), "n_rows": F.count("*").over(whole)})
    by = [*series.keys, CHUNK]
    out = assign_chunks(df, series, rows_per_chunk)
    w = Window.partitionBy(*series.keys)
    past = w.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    lead = (
        out.groupBy(*by)
        .agg(F.count("*").alias("_n"))
        .select(
            *by,
            F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_w"),
            F.sum("_n").over(w).alias("n_rows"),
            F.lit(True).alias(HALO),
        )
    )
    rows = out.withColumns({"_w": F.lit(1).cast("long"), HALO: F.lit(False)})
    inside = Window.partitionBy(*by).orderBy(F.col(HALO).desc(), *series.order())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    stacked = rows.unionByName(lead, allowMissingColumns=True).withColumns(
        {"row_no": F.sum("_w").over(upto), "n_rows": F.first("n_rows").over(upto)}
    )
    return stacked.where(~F.col(HALO)).select(*df.columns, "row_no", "n_rows")


def running_total(df: DataFrame, keys: list[str], part: str, order: str, value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` along ``order`` per key, taken part by part.

    ``part`` must rise with ``order``. Each part is summed first, so only part totals meet in one place; what lies
    before a part enters it as one more row.
    """
    by = [*keys, part]
    past = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    lead = (
        df.groupBy(*by)
        .agg(F.sum(value).alias("_s"))
        .select(*by, F.coalesce(F.sum("_s").over(past), F.lit(0)).alias(value), F.lit(True).alias(HALO))
    )
    stacked = df.withColumn(HALO, F.lit(False)).unionByName(lead, allowMissingColumns=True)
    upto = Window.partitionBy(*by).orderBy(F.col(HALO).desc(), order).rowsBetween(Window.unboundedPreceding, 0)
    return stacked.withColumn(out, F.sum(value).over(upto)).where(~F.col(HALO)).drop(HALO)

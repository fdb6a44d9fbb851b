"""Coercion, filters, de-duplication and column shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from driftline.functions.numeric import number
from driftline.functions.temporal import parse_ts
from driftline.functions.text import RELEVANT_PATTERN, article_text, is_relevant

# Columns that must never reach a model.
LEAKAGE_COLUMNS = ("target_up", "future_return")


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: number(c) for c in cols if c in df.columns})


def coerce_ts(df: DataFrame, col: str, **kw) -> DataFrame:
    return df.withColumn(col, parse_ts(col, **kw))


def drop_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def between_days(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Whole days from ``start`` to ``end``; the last second of the end day closes the range."""
    kind = dict(df.dtypes)[ts]
    first = F.lit(start).cast(kind)
    last = F.lit(end).cast(kind) + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '1' SECOND")
    return df.where((F.col(ts) >= first) & (F.col(ts) <= last))


def relevant_only(df: DataFrame, title="title", description="description", pattern: str = RELEVANT_PATTERN) -> DataFrame:
    return df.where(is_relevant(article_text(title, description), pattern))


def nonblank_text(df: DataFrame, out: str = "text_nlp") -> DataFrame:
    """Build the article text where absent and keep rows that hold more than blanks."""
    if out not in df.columns:
        title = F.col("title") if "title" in df.columns else F.lit(None).cast("string")
        body = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
        df = df.withColumn(out, article_text(title, body))
    return df.where(F.coalesce(F.col(out), F.lit("")).rlike(r"\S"))


def cutoff_counts(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """Rows on either side of a cut-off and whether all lie after it."""
    at = F.lit(cutoff).cast(dict(df.dtypes)[ts])
    return df.agg(
        F.count_if(F.col(ts) < at).alias("n_before"),
        F.count_if(F.col(ts) >= at).alias("n_from"),
        F.every(F.col(ts) >= at).cast("int").alias("all_from"),
    )


def since_cutoff(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    return df.where(F.col(ts) >= F.lit(cutoff).cast(dict(df.dtypes)[ts]))


def recent_or_all(df: DataFrame, ts: str, end: str, hours: int = 48) -> DataFrame:
    """Rows of the last ``hours`` before ``end``, or every row if there are none; ``scope`` says which."""
    floor = F.lit(end).cast(dict(df.dtypes)[ts]) - F.expr(f"INTERVAL '{hours}' HOUR")
    recent = df.where(F.col(ts) >= floor)
    # one row answers the question, so the bound reaches the scan in both steps
    if recent.limit(1).count():
        return recent.withColumn("scope", F.lit("recent"))
    return df.withColumn("scope", F.lit("all"))


def align_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns`` in that order (after ``keep``); missing ones are 0, others are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in columns])


def fill_and_cast(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null to 0, then single precision as the models were fed."""
    return df.withColumns({c: F.coalesce(number(c), F.lit(0.0)).cast("float") for c in columns})


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in LEAKAGE_COLUMNS if c in df.columns])


def unpivot_models(df: DataFrame, ts: str, models: Sequence[str]) -> DataFrame:
    """Wide predictions to (ts, model, pred), nulls dropped."""
    wide = df.select(ts, *[F.col(m).cast("double").alias(m) for m in models])
    return wide.unpivot([ts], list(models), "model", "pred").na.drop()


def candle_direction(open_: str = "open", close: str = "close") -> Column:
    return F.when(F.col(open_) <= F.col(close), "up").otherwise("down")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a total order.

    The rank limit runs before the shuffle, so each map task sends one row per key however many copies there are.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1).drop("_rn")


def dup_report(df: DataFrame, keys: Sequence[str], fail: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count."""
    found = df.groupBy(*keys).agg(F.count("*").alias("n_copies")).where("n_copies > 1")
    if fail and found.limit(1).count():
        raise ValueError(f"duplicate rows for {list(keys)}")
    return found

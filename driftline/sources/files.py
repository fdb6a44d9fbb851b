"""Readers of landed files. Text is read as strings and coerced with explicit rules, so no schema is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from driftline.functions.numeric import number
from driftline.functions.temporal import TS_FORMATS, parse_ts
from driftline.operators.clean import coerce_numeric, dedupe_first

OHLC = ("open", "high", "low", "close")
# Accepted column names.
TIME_NAMES = ("datetime", "date", "timestamp", "time")
NEWS_TIME_NAMES = ("published_at", "publishedAt", "datetime", "date")
DATASET_TIME_NAMES = ("timestamp", "datetime")
OLD_TIME_NAMES = ("timestamp", "datetime", "date", "time", "published_at", "publishedAt")
PREDICTION_NAMES = ("pred", "forecast", "prediction")
TRUTH_NAMES = ("actual", "price", "y")
INDEX_HINTS = ("fear", "greed", "fng")
EMPTY_INDEX = "datetime timestamp, fear_greed_index double"
EMPTY_PREDICTIONS = "datetime timestamp, y_pred double, y_true double, proba_up double"


def read_text_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """All columns as strings, headers trimmed, doubled quotes kept together.

    With ``line_breaks`` fields may hold quoted line breaks; such a file is read by one task, so land large feeds as
    many files, or as parquet. Without, files are split.
    """
    df = spark.read.csv(path, sep=sep, header=True, multiLine=line_breaks, escape='"', inferSchema=False)
    return df.toDF(*[c.strip() for c in df.columns])


def _need(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def _first_of(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((c for c in names if c in df.columns), None)


def as_ohlc(df: DataFrame, ts_formats: Sequence[str] = TS_FORMATS) -> DataFrame:
    """Strict candles: parsed time, four numeric prices, incomplete rows dropped."""
    _need(df, ["datetime", *OHLC])
    out = coerce_numeric(df.withColumn("datetime", parse_ts("datetime", tuple(ts_formats))), OHLC)
    return out.na.drop(subset=["datetime", *OHLC])


def read_ohlc(spark: SparkSession, path, sep: str = ";", ts_formats: Sequence[str] = TS_FORMATS) -> DataFrame:
    return as_ohlc(read_text_csv(spark, path, sep), ts_formats)


def as_prices(df: DataFrame) -> DataFrame:
    """Lenient prices: ``date`` may stand for the time, ``price`` is the close, only the time must be known."""
    if "datetime" not in df.columns and "date" in df.columns:
        df = df.withColumnRenamed("date", "datetime")
    _need(df, ["datetime"])
    close = F.col("close") if "close" in df.columns else F.lit(None).cast("double")
    out = df.withColumn("datetime", parse_ts("datetime")).withColumn("price", close)
    return coerce_numeric(out, [*OHLC, "price"]).na.drop(subset=["datetime"])


def read_prices(spark: SparkSession, path, sep: str = ";") -> DataFrame:
    return as_prices(read_text_csv(spark, path, sep))


def as_news(df: DataFrame) -> DataFrame:
    """Articles with a known time, one per (published_at, title, source) as far as those columns exist."""
    _need(df, ["published_at"])
    text = [c for c in ("title", "description", "source", "axis") if c in df.columns]
    out = df.withColumns({"published_at": parse_ts("published_at"), **{c: F.col(c).cast("string") for c in text}})
    keys = [c for c in ("published_at", "title", "source") if c in df.columns]
    rest = [c for c in out.columns if c not in keys]
    return dedupe_first(out.na.drop(subset=["published_at"]), keys, ["published_at", *rest])


def read_news(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    return as_news(read_text_csv(spark, path, sep, line_breaks=True))


def as_news_any_ts(df: DataFrame, out: str = "published_at") -> DataFrame:
    """First known time column under any accepted name; unknown times and copies stay."""
    name = _first_of(df, NEWS_TIME_NAMES)
    if name is None:
        raise ValueError(f"no time column among {NEWS_TIME_NAMES}")
    return df.withColumnRenamed(name, out).withColumn(out, parse_ts(out))


def read_news_any_ts(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    return as_news_any_ts(read_text_csv(spark, path, sep, line_breaks=True))


def as_index(df: DataFrame) -> DataFrame:
    """Daily index: value column found by name, first column is the time if unnamed, time floored to the hour."""
    if "fear_greed_index" not in df.columns:
        found = [c for c in df.columns if any(h in c.lower() for h in INDEX_HINTS)]
        if not found:
            raise ValueError("no index value column")
        df = df.withColumnRenamed(found[0], "fear_greed_index")
    if "datetime" not in df.columns:
        df = df.withColumnRenamed(df.columns[0], "datetime")
    return df.select(
        F.date_trunc("hour", parse_ts("datetime")).alias("datetime"), number("fear_greed_index").alias("fear_greed_index")
    ).na.drop()


def read_index(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """Unreadable input gives an empty index, and so the default value downstream."""
    try:
        return as_index(read_text_csv(spark, path, sep))
    except (AnalysisException, ValueError):
        return spark.createDataFrame([], EMPTY_INDEX)


def as_predictions(df: DataFrame, pred_col: str = "y_pred") -> DataFrame | None:
    """Time, prediction, truth and probability under their accepted names; None when time or prediction is absent."""
    name = _first_of(df, TIME_NAMES)
    if name is None:
        return None
    df = df.withColumnRenamed(name, "datetime") if name != "datetime" else df
    if pred_col not in df.columns:
        alias = _first_of(df, ("y_pred", *PREDICTION_NAMES))
        if alias is None:
            return None
        df = df.withColumnRenamed(alias, pred_col)
    if "y_true" not in df.columns:
        alias = _first_of(df, TRUTH_NAMES)
        if alias:
            df = df.withColumnRenamed(alias, "y_true")
    keep = [c for c in (pred_col, "y_true", "proba_up") if c in df.columns]
    out = df.select(parse_ts("datetime").alias("datetime"), *[number(c).alias(c) for c in keep])
    return out.na.drop(subset=["datetime"])


def read_predictions(spark: SparkSession, path, pred_col: str = "y_pred", sep: str = ",") -> DataFrame:
    empty = spark.createDataFrame([], EMPTY_PREDICTIONS).withColumnRenamed("y_pred", pred_col)
    try:
        found = as_predictions(read_text_csv(spark, path, sep), pred_col)
    except AnalysisException:
        return empty
    return empty if found is None else found


def as_dataset(df: DataFrame, out: str = "timestamp") -> DataFrame:
    """Feature rows with a known time; every other column is numeric."""
    name = _first_of(df, DATASET_TIME_NAMES)
    if name is None:
        raise ValueError(f"no time column among {DATASET_TIME_NAMES}")
    if dict(df.dtypes)[name] == "string":
        df = df.withColumn(name, parse_ts(name))
    df = df.withColumnRenamed(name, out)
    return coerce_numeric(df, [c for c, t in df.dtypes if t == "string"]).na.drop(subset=[out])


def read_feature_dataset(spark: SparkSession, root: str, task: str, resolution: str) -> DataFrame:
    """Stored features of one task and resolution; the folder layout prunes the rest. Missing input is empty."""
    if task not in ("sentiment", "price"):
        raise ValueError("task is 'sentiment' or 'price'")
    try:
        stored = spark.read.parquet(root)
    except AnalysisException:
        return spark.createDataFrame([], "timestamp timestamp")
    return as_dataset(stored.where((F.col("task") == task) & (F.col("resolution") == resolution)))


def as_strict_dataset(df: DataFrame, ts: str = "datetime", fmt: str | None = None) -> DataFrame:
    """As :func:`as_dataset`, but unreadable time fails the job."""
    parsed = F.to_timestamp(ts, fmt) if fmt else F.col(ts).cast("timestamp")
    return df.withColumn(ts, parsed)


def as_old_dataset(df: DataFrame, out: str = "timestamp") -> DataFrame:
    """Older exports: any of six time names, unreadable time becomes null and stays."""
    name = _first_of(df, OLD_TIME_NAMES)
    if name is None:
        raise ValueError(f"no time column among {OLD_TIME_NAMES}")
    return df.withColumnRenamed(name, out).withColumn(out, parse_ts(out))


def read_feature_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Ordered model inputs from a JSON list; None when the file is missing, empty or no list."""
    try:
        row = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("c")).first()
    except AnalysisException:
        return None
    return list(row["c"]) if row and row["c"] else None

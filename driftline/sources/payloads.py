"""Landed API payloads: one JSON document per row, parsed with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.numeric import number
from driftline.functions.temporal import parse_ts

INDEX_SCHEMA = "struct<data:array<struct<value:string,timestamp:string>>>"
NEWS_SCHEMA = (
    "struct<status:string,articles:array<struct<publishedAt:string,title:string,description:string,"
    "source:struct<name:string>>>>"
)
# Positions of the fields of a candle array.
KLINE_FIELDS = (
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume", "ignore",
)


def _parsed(payload: Column | str, schema: str) -> Column:
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(c, schema)


def parse_index(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Daily index rows; epoch seconds arrive as text."""
    item = df.select(F.explode(_parsed(payload, INDEX_SCHEMA)["data"]).alias("d"))
    return item.select(
        F.timestamp_seconds(F.col("d.timestamp").try_cast("long")).alias("datetime"),
        number("d.value").alias("fear_greed_index"),
    )


def parse_klines(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Candles from positional arrays; epoch milliseconds, numbers arrive as text."""
    row = df.select(F.explode(_parsed(payload, "array<array<string>>")).alias("k"))
    field = lambda name: F.get("k", F.lit(KLINE_FIELDS.index(name)))
    return row.select(
        F.timestamp_millis(field("open_time").try_cast("long")).alias("datetime"),
        *[number(field(c)).alias(c) for c in ("open", "high", "low", "close")],
    )


def parse_articles(df: DataFrame, payload: str = "payload", axis: str = "axis") -> DataFrame:
    """Articles of the payloads that report success, tagged with the axis they were fetched for."""
    doc = df.select(axis, _parsed(payload, NEWS_SCHEMA).alias("p")).where(F.col("p.status") == "ok")
    item = doc.select(axis, F.explode("p.articles").alias("a"))
    return item.select(
        parse_ts("a.publishedAt").alias("published_at"),
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.source.name").alias("source"),
        F.col(axis).alias("axis"),
    )

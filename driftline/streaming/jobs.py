"""Live feeds: windowed sentiment and candles, de-duplication, features and scores per micro-batch."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from driftline.operators.buckets import ohlc_resample, sentiment_null_policy, sentiment_wide
from driftline.operators.ordered import Series
from driftline.operators.rolling import ROLL_ROWS, rolling_block


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; zone-less times are UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_bucket_agg(
    stream: DataFrame, keys: Sequence[str], ts: str, freq: str, axes: Sequence[str], delay: str = "1 hour", **names
) -> DataFrame:
    """The batch aggregate of :func:`sentiment_wide` on a stream; a bucket is final once the watermark passes it."""
    return sentiment_null_policy(sentiment_wide(with_event_time(stream, ts, delay), keys, ts, freq, axes, **names))


def stream_ohlc(stream: DataFrame, keys: Sequence[str], ts: str, price: str, freq: str, delay: str = "1 hour", tie=None):
    return ohlc_resample(with_event_time(stream, ts, delay), keys, ts, price, freq, tie)


def stream_dedupe(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """One row per key among rows that arrive within the delay."""
    return with_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(stream: DataFrame, target: str, state: str, mode: str = "append") -> StreamingQuery:
    """Work off what has landed, write parquet, stop. Restarting from ``state`` continues where it ended."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", target)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def feature_writer(
    keys: Sequence[str], root: str, means: Sequence[str], score: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """Handler for ``foreachBatch`` over closed buckets: roll the new buckets onto the last ones of each series.

    The last rows of every series, all that the rolling windows reach back to, are kept as one small table per
    epoch. A replayed epoch reads the state of the one before and overwrites its own output, so results stay exact.
    """
    series = Series(tuple(keys), "bucket")

    def tail_path(epoch: int) -> str:
        return os.path.join(root, "tail", f"epoch={epoch}")

    def handle(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("_new", F.lit(True))
        # a tail that is gone must stop the stream: without it the rolling features would start anew unnoticed
        old = spark.read.parquet(tail_path(epoch - 1)).withColumn("_new", F.lit(False)) if epoch else None
        known = fresh if old is None else fresh.unionByName(old)
        known = known.persist()
        out = rolling_block(known, series, means, split=False).where("_new").drop("_new")
        if score:
            out = score(out)
        out.write.mode("overwrite").parquet(os.path.join(root, "features", f"epoch={epoch}"))
        last = known.drop("_new").withColumn("_rn", F.row_number().over(series.window(descending=True)))
        last.where(F.col("_rn") <= ROLL_ROWS + 1).drop("_rn").write.mode("overwrite").parquet(tail_path(epoch))
        known.unpersist()

    return handle


def stream_features(
    closed: DataFrame,
    keys: Sequence[str],
    root: str,
    state: str,
    means: Sequence[str],
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Run :func:`feature_writer` over what has landed. ``closed`` emits each bucket once, in append mode."""
    query = (
        closed.writeStream.outputMode("append")
        .option("checkpointLocation", state)
        .foreachBatch(feature_writer(keys, root, means, score))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

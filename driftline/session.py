"""Session set-up, shared scratch folder and the size checks behind every broadcast."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 200_000


def build_session(app: str = "driftline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # stream state larger than the heap
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on, whoever built the session."""
    import driftline

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # functions run in Python workers travel with the job, so executors need no copy of the package
    cloudpickle.register_pickle_by_value(driftline)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``; a private one only for a local master.

    On a cluster a folder of one machine would lose what executors write to theirs, so none is made up there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="driftline-"))
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of the files a frame is computed from, as Catalyst sees them after pruning; None when unknown.

    Estimates further up the plan are of little use here: without column statistics a join counts as a product.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:
        return None


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = source_bytes(df)
    return size is not None and size <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for what comes from little input; otherwise Spark decides by the size it meets."""
    return F.broadcast(df) if is_small(df, limit) else df


def pin(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write a small aggregate to the shared folder, and hint its broadcast only if its counted size is small."""
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    # the count comes from the file footers
    small = is_small(stored, BROADCAST_BYTES) and stored.count() <= max_rows
    return F.broadcast(stored) if small else stored


# logical operators whose result is costly to compute again
_COSTLY = re.compile(r"\b(Join|Aggregate|Window|Sort|MapInPandas|FlatMapGroupsInPandas|Distinct)\b")


def is_plain_scan(df: DataFrame) -> bool:
    """Whether reading ``df`` again costs no more than a pruned scan."""
    try:
        return not _COSTLY.search(df._jdf.queryExecution().optimizedPlan().toString())
    except Exception:
        return False


def settle(df: DataFrame) -> DataFrame:
    """Give a frame that is read several times a table of its own on the shared folder, unless it is a plain scan.

    This also keeps plans from doubling when ordered steps are stacked, and survives the loss of executors.
    """
    if is_plain_scan(df):
        return df
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_same(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal keys, null keys included; the keys come from the left side. Both sides still hash by key."""
    own = {c: f"_same_{c}" for c in keys}
    other = right.select(*[F.col(c).alias(own[c]) if c in own else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in keys:
        cond = cond & left[c].eqNullSafe(other[own[c]])
    return left.join(other, cond, how).drop(*own.values())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))

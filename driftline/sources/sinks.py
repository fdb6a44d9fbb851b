"""Writers: partitioned feature tables, revisions, prediction log, refresh, export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_COLUMNS = ("timestamp", "task", "model", "resolution", "prediction", "proba_up", "confidence")


def write_features(df: DataFrame, root: str, task: str, resolution: str) -> None:
    """Replace the stored features of one task and resolution and leave the others."""
    (
        df.withColumns({"task": F.lit(task), "resolution": F.lit(resolution)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("task", "resolution")
        .parquet(root)
    )


def latest_revision(spark: SparkSession, root: str) -> int:
    """Highest stored revision, 0 for none. Lists folder names only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max((int(n.split("=")[1]) for n in names if n.startswith("revision=")), default=0)


def write_versioned(df: DataFrame, root: str) -> int:
    """Append under the next free revision and return it."""
    revision = latest_revision(df.sparkSession, root) + 1
    df.withColumn("revision", F.lit(revision)).write.mode("append").partitionBy("revision").parquet(root)
    return revision


def write_prediction_log(df: DataFrame, root: str) -> None:
    df.select(*LOG_COLUMNS).write.mode("append").parquet(root)


def refresh(df: DataFrame, root: str, partitions: Sequence[str] = ()) -> None:
    """Overwrite landed data; with ``partitions`` only the ones present in ``df``."""
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(root)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"')

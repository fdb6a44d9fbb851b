"""Sharding by jump consistent hashing: the shard follows from the key and the number of shards alone.

The hash needs no ring and no table; with one more shard, a row either stays or moves into the new one. It is the
published generator (a 64-bit linear congruence, a jump by its top 31 bits), written in column expressions: products
are taken in limbs of 22 bits, as Spark's checked arithmetic does not wrap.

Slots number the rows of a shard by (key, row) without gathering a shard: rows are cut into key ranges, each range counts its
rows per shard, and a row's slot is its rank in (range, shard) plus the counts of the ranges before.

Defined cases: a null key is taken as 0, so its shard is fixed too; a null text has size 1 and CRC 0; repeated keys share a
shard and take different slots; an empty table gives an empty one. Columns other than key and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import settled

MULTIPLIER = 2862933555777941757  # fixed value of the published hash
RANGE_ROWS = 200_000


def _next_state(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2^64, on signed 64-bit numbers."""
    bits = 22
    low = (1 << bits) - 1
    a = [key.bitwiseAND(F.lit(low)), F.shiftrightunsigned(key, bits).bitwiseAND(F.lit(low)), F.shiftrightunsigned(key, 2 * bits)]
    b = [F.lit((MULTIPLIER >> (bits * i)) & low).cast("bigint") for i in range(3)]
    p1 = a[0] * b[1] + a[1] * b[0]
    p2 = a[0] * b[2] + a[1] * b[1] + a[2] * b[0]
    s0 = a[0] * b[0] + 1 + F.shiftleft(p1.bitwiseAND(F.lit(low)), bits)
    high = (F.shiftright(s0, 2 * bits) + F.shiftright(p1, bits) + p2).bitwiseAND(F.lit((1 << 20) - 1))
    return F.shiftleft(high, 2 * bits).bitwiseOR(s0.bitwiseAND(F.lit((1 << (2 * bits)) - 1)))


def jump_hashes(key: Column, shards: int, grown: int) -> Column:
    """struct(shard, grown_shard): the buckets of a 64-bit key among ``shards`` and among ``grown`` >= ``shards``.

    Every jump goes ahead by one bucket at least, so ``grown`` steps reach the end; the walk for fewer shards is the
    same one, stopped earlier.
    """
    start = F.struct(key.alias("key"), F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("last"))

    def step(s: Column, _: Column) -> Column:
        here = s["at"]
        nxt = _next_state(s["key"])
        ahead = F.floor((here + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(nxt, 33) + 1).cast("double")))
        moved = F.struct(
            nxt.alias("key"),
            ahead.alias("at"),
            F.when(here < shards, here).otherwise(s["shard"]).alias("shard"),
            here.alias("last"),
        )
        return F.when(here < grown, moved).otherwise(s)

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(grown)), start, step)
    return F.struct(walk["shard"].cast("int").alias("shard"), walk["last"].cast("int").alias("grown_shard"))


def assign_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row."""
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(0).cast("bigint"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_hashes(number, shards, shards + 1).alias("to"),
        F.monotonically_increasing_id().alias("row"),
    ).select("key", "size", "text_crc32", "to.*", "row")
    rows = settled(rows, "shard-rows")
    ranges = max(8, -(-rows.count() // range_rows))
    # equal keys may fall into several ranges, by row
    cut = settled(rows.repartitionByRange(ranges, "key", "row").withColumn("range", F.spark_partition_id()), "shard-ranges")
    per_range = cut.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = per_range.select("range", "shard", before.alias("base"))
    rank = F.row_number().over(Window.partitionBy("range", "shard").orderBy("key", "row"))
    # one row for each range and shard: few however long the table is
    out = cut.withColumn("rank", rank).join(F.broadcast(base) if ranges * shards <= 100_000 else base, ["range", "shard"])
    return out.select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1).alias("slot"), "grown_shard")

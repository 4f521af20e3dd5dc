"""Dealing documents to shards by jump consistent hashing, in DataFrame functions alone.

The law is `key`: doc_id and the number of shards decide.  Jump hashing walks through the shard counts at which a key would move, drawing each
next one from a stream of numbers that the key seeds (here xxhash64 of doc_id and the step); the last one below the count is
the shard.  There is no ring table, and one more shard takes rows only into itself, a share of 1 / (n + 1).

A slot is a row's place in its shard, gapless from 0.  Identical rows are counted, not gathered; they are numbered by sums of counts within
small buckets of a shard, whose offsets come from an aggregation, so no shard is sorted in one task.  The copies of a row get their slots in blocks
that are dealt to all tasks.

Defined cases: null and empty texts have size 1 and the checksum 0; a null doc_id is a key like any other; repeated rows get slots of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS, BUCKETS = 16, 1024
#: Copies of a row that one task numbers at once.
BLOCK = 1 << 14


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a key, from 0 to shards - 1."""
    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))

    def step(walk: Column, i: Column) -> Column:
        draw = (F.shiftrightunsigned(F.xxhash64(key, i), 33) + F.lit(1)).cast("double") / F.lit(float(1 << 31))
        moved = F.struct(walk["next"].alias("shard"), F.floor((walk["next"] + F.lit(1)).cast("double") / draw).cast("long").alias("next"))
        return F.when(walk["next"] < F.lit(shards), moved).otherwise(walk)

    # the next count grows by one at least, so `shards` steps always suffice
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["shard"].cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("shard", jump_hash(F.col("doc_id"), shards)).withColumn("grown_shard", jump_hash(F.col("doc_id"), shards + 1))
    key = ["doc_id", "text_crc32", "size"]
    groups = rows.groupBy(*key, "shard", "grown_shard").agg(F.count("*").alias("n")).withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    counts = groups.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("before"))  # shards * buckets rows at most
    place = F.sum("n").over(Window.partitionBy("shard", "bucket").orderBy(*key).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    numbered = groups.withColumn("place", place).join(F.broadcast(offsets), ["shard", "bucket"])
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long"))).alias("skip")
    blocks = numbered.select(*key, "shard", "grown_shard", "n", (F.col("before") + F.col("place")).alias("start"), block).repartition("shard", "start", "skip")
    slots = F.explode(F.sequence(F.col("start") + F.col("skip"), F.col("start") + F.least(F.col("skip") + BLOCK, F.col("n")) - 1)).alias("slot")
    return blocks.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slots, "grown_shard")

"""A row that holds much of the table is numbered by many tasks."""

from pyspark.sql import functions as F

from tallyward.llm import sharding


def test_copies_of_a_row_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 16, raising=False)
    docs = spark.createDataFrame([(7, "a")] * 1005 + [(i, "b") for i in range(50)], "doc_id long, text string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = sharding.shard(docs).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(coalesce)
    for s in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    copies = [r["task"] for r in got if r["doc_id"] == 7]
    assert len(got) == 1055 and sum(r["doc_id"] == 7 for r in got) == 1006
    assert max(copies.count(t) for t in set(copies)) < 0.6 * len(copies)

"""Interval joins and running sums on keys that hold everything."""

import random
import time

from pyspark.sql import functions as F

from tallyward.operators import discovery, rules


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(2)
    spans = []
    for n in range(220):
        a = rng.randrange(2000)
        spans.append((rng.choice(["a", "b", None]), a, a + rng.choice([0, 0, 1, 5, 40, 900]), n))
    spans += [("a", 5, 3, 900), ("a", 700, 700, 901), ("b", None, 3, 902)]
    day = lambda x: F.expr(f"date_add(DATE'1990-01-01', {x})")
    rows = spark.createDataFrame(spans, "k string, s int, e int, n int").select("k", "n", day("s").alias("s"), day("e").alias("e"))
    found = [tuple(r) for r in rules.overlapping(rows, ["k"], "s", "e", "n").collect()]
    want = {(k, i, j) for k, a, b, i in spans for m, c, d, j in spans if k == m and i < j and None not in (a, c) and a <= d and c <= b}
    assert len(found) == len(set(found)) and set(found) == want


def test_many_short_spans_of_one_key(spark):
    n = 100_000
    rows = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("n"), F.timestamp_seconds(F.col("id") * 100).alias("s"), F.timestamp_seconds(F.col("id") * 100 + F.when(F.col("id") % 1000 == 0, 150).otherwise(50)).alias("e"))
    began = time.time()
    assert rules.overlapping(rows, ["k"], "s", "e", "n").count() == n // 1000
    assert time.time() - began < 90  # all pairs would be 5 * 10 ** 9


def test_running_sums_over_blocks(spark):
    n = 2000
    rows = spark.range(n).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("r"), (F.col("id") % 3).alias("v"), F.col("id").alias("o"), (F.col("id") % 7).alias("x"))
    made = discovery.blocked(rows, "r", ["o"])
    assert made.groupBy("r").agg(F.countDistinct("_block").alias("n")).where("r = 'a'").first()["n"] > 1
    got = {(r["o"], r["s"]) for r in discovery.running_before(made, ["r", "v"], ["o"], "x", "s").collect()}
    sums, want = {}, set()
    for i in range(n):
        k = ("b" if i % 10 == 0 else "a", i % 3)
        want.add((i, sums.get(k, 0)))
        sums[k] = sums.get(k, 0) + i % 7
    assert got == want

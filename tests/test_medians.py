"""Exact medians, however crowded the values are."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyward.operators import discovery


def medians(spark, groups):
    rows = spark.createDataFrame([(g, x) for g, values in groups.items() for x in values], "g string, x double").repartition(4)
    return {r["g"]: r["m"] for r in discovery.exact_medians(rows, ["g"], {"m": F.col("x")}).collect()}


def test_small_groups_ties_and_signs(spark):
    rng = random.Random(5)
    groups = {f"{n}-{k}": [rng.choice([-3.0, -1e-9, 0.0, 0.1, 2.0, 1e9]) if k else rng.uniform(-5, 5) for _ in range(n)] for n in range(1, 40) for k in (0, 1)}
    groups |= {None: [1.0, 2.0], "tie": [7.0] * 5000 + [1.0] * 4999, "half": [1.0] * 500 + [2.0] * 500}
    assert medians(spark, groups) == {g: statistics.median(x) for g, x in groups.items()}


@pytest.mark.parametrize("spread", [1e-12, 3e-4, 1e6])
def test_crowded_values(spark, spread):
    n = 300_001
    rows = spark.range(n).select(F.lit("a").alias("g"), (1 + F.pmod(F.col("id") * 7919, F.lit(n)) * (spread / n)).alias("x"))
    assert discovery.exact_medians(rows, ["g"], {"m": F.col("x")}).first()["m"] == rows.agg(F.expr("percentile(x, 0.5)")).first()[0]
    # what is put in order stays a small part of the group
    assert discovery.middle_counts(rows, ["g"], {"m": F.col("x")}).count() < n / 300


def test_columns_without_values(spark):
    rows = spark.createDataFrame([("a", 1.0, None), ("a", None, None), ("b", 3.0, 4.0)], "g string, x double, y double")
    got = {r["g"]: (r["p"], r["q"]) for r in discovery.exact_medians(rows, ["g"], {"p": F.col("x"), "q": F.col("y")}).collect()}
    assert got == {"a": (1.0, None), "b": (3.0, 4.0)}

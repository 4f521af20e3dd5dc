"""Pairwise deviation: equal points as one with a weight, against all distances."""

import math
import random
import time

from pyspark.sql import functions as F

from tallyward.operators import discovery


def test_sums_equal_all_distances(spark, monkeypatch):
    monkeypatch.setattr(discovery, "TILE", 16)
    rng = random.Random(4)
    points = [("a", i, float(rng.randrange(12)), float(rng.choice([0, 0, 0, 1, 5]))) for i in range(300)] + [("b", i, rng.random(), rng.random()) for i in range(60)] + [("c", i, 1.0, 1.0) for i in range(10)]
    got = {(r["grp"], r["id"]): (r["global"], r["local"]) for r in discovery.pair_deviation(spark.createDataFrame(points, "grp string, id long, x double, y double"), trim=1e9).collect()}
    for g in "ab":
        own = [(i, x, y) for k, i, x, y in points if k == g]
        for i, x, y in own:
            d = sorted(math.hypot(x - u, y - v) for _, u, v in own)
            assert math.isclose(got[g, i][0], sum(d), rel_tol=1e-9) and math.isclose(got[g, i][1], sum(d[:5]), rel_tol=1e-9, abs_tol=1e-12)
    assert len(got) == 360


def test_a_million_points_on_a_lattice(spark):
    rows = spark.range(1_000_000).select(F.lit("a").alias("grp"), "id", F.pmod(F.xxhash64("id"), F.lit(40)).cast("double").alias("x"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("double").alias("y"))
    began = time.time()
    assert discovery.pair_deviation(rows).agg(F.count("*"), F.max("global")).first()[0] > 900_000
    assert time.time() - began < 240


def test_each_distinct_point_is_one_row_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(discovery, "TILE", 16)
    made, seen = discovery._distance_rows, str(tmp_path / "rows")

    def counted(batches):
        for out in made(batches):
            with open(seen, "a") as f:
                f.write(f"{out.num_rows}\n")
            yield out

    monkeypatch.setattr(discovery, "_distance_rows", counted)
    points = [("a", i, float(i % 20), float(i % 17)) for i in range(500)]
    got = discovery.pair_deviation(spark.createDataFrame(points, "grp string, id long, x double, y double"), trim=1e9)
    assert got.count() == 500
    assert sum(map(int, open(seen))) == 340

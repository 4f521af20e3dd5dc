"""Near-equal columns: the signature path against all pairs."""

import random

from pyspark.sql import functions as F

from tallyward.operators import discovery


def test_signatures_lose_no_pair(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        base = [str(rng.randrange(4)) for _ in range(6)]
        near = [x if rng.random() < p else "z" for x, p in zip(base, (1, 0.97, 0.955, 0.94, 0.5, 0), strict=True)]
        rows.append((*base, *near, base[0] + ".0", None if i % 40 == 0 else base[1], "" if i % 3 else base[2]))
    names = [f"c{k}" for k in range(len(rows[0]))]
    frame = spark.createDataFrame(rows, ", ".join(f"{x} string" for x in names))
    few = {tuple(r) for r in discovery._few_equal_pairs(frame, names, 0.95, 30).collect()}
    assert ("c0", "c12", 1.0) in few and len(few) > 3
    for limit in (1 << 30, 500):
        monkeypatch.setattr(discovery, "SIGNATURE_ROWS", limit)
        assert {tuple(r) for r in discovery._many_equal_pairs(frame, names, 0.95, 30, 1e-12).collect()} == few


def test_many_columns(spark):
    """Each column has one near twin; recall of all pairs that there are is 1."""
    n = 120
    cells = [f"CAST(pmod(xxhash64(id, {i}), 50) AS string) AS x{i}" for i in range(n)] + [f"CAST(CASE WHEN id % 40 = 0 THEN -1 ELSE pmod(xxhash64(id, {i}), 50) END AS string) AS y{i}" for i in range(n)]
    frame = spark.range(10_000).selectExpr(*cells)
    got = discovery.equal_pairs(frame, frame.columns).select("variable_1", "variable_2", F.round("share", 3).alias("share")).collect()
    assert {tuple(r) for r in got} == {(f"x{i}", f"y{i}", 0.975) for i in range(n)}

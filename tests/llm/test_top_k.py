"""Top-k search: groups of tiles, their exactness, and what reaches the driver."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyward.llm import topk


def test_no_table_is_sent_through_the_driver(spark):
    """A broadcast of the query tiles, copied to all slots, took more than the driver's memory at 615,384 vectors."""
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*(F.sin(F.col("id") * (i + 1)) for i in range(8))).alias("embedding"))
    found = topk.top_k(df, df.where("vec_id % 100 = 0"), 10)
    assert len(found.collect()) == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "isFinalPlan=true" in plan


def packed(rows, n, tile):
    """Tiles of rows (vec_id, components)."""
    tiles = [topk._tile(n, np.array([i for i, _ in rows[at : at + tile]], np.int64), np.array([v for _, v in rows[at : at + tile]], np.int64).reshape(-1, n)) for at in range(0, len(rows), tile)]
    return pa.Table.from_batches(tiles)


def brute(asked, rows, k):
    out = set()
    for q, v in asked:
        best = {}
        for i, w in rows:
            if i != q:
                s = sum(a * b for a, b in zip(v, w, strict=True))
                best[i] = max(s, best.get(i, s))
        out |= {(q, i, s) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]}
    return out


@pytest.mark.parametrize("largest", [0, 1, 1 << 9, 1 << 15, 1 << 20, 1 << 29])
@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("tile", [3, 16, 200])
def test_lists_of_a_group_equal_brute_force(largest, repeated, tile):
    """Products in floats, doubles and integers; scores whose last bit decides; ties; ids that repeat within and between tiles."""
    rng, n, k = random.Random(largest + tile), 5, 10
    rows = [(i % 150 if repeated else i, [rng.randrange(-largest, largest + 1) for _ in range(n)]) for i in range(300)]
    rows += [(1000 + i, [largest] * n) for i in range(60)] + [(2000 + i, [largest] * (n - 1) + [max(0, largest - 1)]) for i in range(20)]
    rng.shuffle(rows)
    asked = [x for x in rows if x[0] % 50 == 0]
    key = tuple(pa.scalar(x) for x in (7, 0, n))
    got = topk._group_rows(key, packed(asked, n, 4), packed(rows, n, tile), k)
    lists = {(q, i, s) for q, i, s, _ in zip(*got.to_pydict().values(), strict=True)}
    if repeated:  # a query id that repeats has a list for each of its rows; they are merged later
        assert {(q, i, s) for q, v in asked for q, i, s in brute([(q, v)], rows, k)} == lists
    else:
        assert lists == brute(asked, rows, k) and got.num_rows == len(lists)
    assert set(got.column("branch").to_pylist()) == {7}


def test_a_group_without_queries_or_candidates_gives_no_rows():
    rows = packed([(1, [1, 2]), (2, [3, 4])], 2, 5)
    key = tuple(pa.scalar(x) for x in (0, 0, 2))
    for asked, tiles in ((rows, rows.slice(0, 0)), (rows.slice(0, 0), rows)):
        assert topk._group_rows(key, asked, tiles, 3).num_rows == 0


def test_slots_and_shares_give_the_same_lists(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ask = lambda: sorted(map(tuple, topk.top_k(df, df.where("vec_id % 4 = 0"), 5).collect()))
    whole = ask()
    for name, value in (("QUERY_TILE", 8), ("CANDIDATE_TILE", 16), ("GROUP_COMPONENTS", 100)):
        monkeypatch.setattr(topk, name, value)
    assert topk._grid((100, 400), (400, 1600), 12) == (16, 4)
    assert ask() == whole and len(whole) == 500


def test_copies_of_tiles_stay_in_proportion():
    """Queries are one in a hundred: what a task holds stays, and copies make the tables a few times as large at most."""
    for rows in (2000, 51_282, 615_384, 15_000_000):
        asked, all_of = (rows // 100, 64 * rows // 100), (rows, 64 * rows)
        slots, shares = topk._grid(asked, all_of, 36)
        assert slots * asked[1] + shares * all_of[1] <= 4 * (asked[1] + all_of[1])
        assert all_of[1] / slots <= topk.GROUP_COMPONENTS and asked[1] / shares <= topk.GROUP_COMPONENTS

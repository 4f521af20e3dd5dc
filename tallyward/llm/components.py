"""Connected components of a graph of edges, by alternating large-star and small-star rounds.

Each round is a join with per-node minima that were aggregated and written first, so a node with very many edges is never gathered and
Spark can split its part of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import kept


def _minima(edges: DataFrame) -> DataFrame:
    return kept(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that isn't itself the smallest of its component; edges: (a, b), longs, in any direction.

    Self-loops and repeated edges don't matter; rows with a null end are no edges; no edges give no rows.
    """
    ends = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = kept(ends, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = kept(large, "large")
        small = large.join(_minima(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        now = kept(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

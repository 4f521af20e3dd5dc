"""Exact top-k search by integer inner product.

Each component x becomes floor(1024 * x).  Queries and candidates are packed into tiles of a bounded size.  Candidate tiles are dealt over
slots and query tiles over shares; a slot meets a share in one cogroup of bounded size, so no task holds all queries or all candidates, and
nothing is broadcast.  A product of a query tile with a candidate tile scores all pairs of both; a query tile meets the slot's tiles one
after another and keeps each query's best k, so that only scores that reach a list are looked at.  Lists of the slots are then merged in a
tree: rounds of bounded fan-in keep the best k of each query until one list is left.

Scores are exact: by the norms of the two tiles every partial sum stays below 2**24 (then products are computed in floats) or 2**53 (in
doubles); others are computed in 64-bit integers (which wrap beyond a long).
Ties go to the smaller vec_id.  Vectors that are null, or hold null or components that aren't finite, take no part; neither do rows with a
null vec_id.  A vector scores only against vectors of its own length; among empty vectors every score is 0.  Rows that repeat a vec_id are one candidate with the best of their
scores, and never a candidate of their own id's queries; a query id that repeats gets one list, the best scores of its rows.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_TILE, CANDIDATE_TILE, FAN_IN = 512, 2048, 16
#: Components of a tile at most, so that long vectors make shorter tiles.
TILE_COMPONENTS = 1 << 20
#: Components of a slot's candidates, and of a share's queries, on average at most.
GROUP_COMPONENTS = 1 << 23
_TILES = "size int, ids binary, vectors binary"
_LEAST = np.iinfo(np.int64).min


def _tile_rows(batches, most: int):
    """Packs usable vectors into tiles, by length."""
    open_tiles: dict[int, tuple[list[np.ndarray], list[np.ndarray], int]] = {}
    for batch in batches:
        ids, lists = batch.column("vec_id"), batch.column("embedding").cast(pa.list_(pa.float64()))
        size = np.asarray(lists.value_lengths().fill_null(0))
        flat = lists.flatten()
        values = np.asarray(flat.fill_null(float("nan")))
        first = np.concatenate([[0], np.cumsum(size)])
        broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        usable = np.asarray(lists.is_valid()) & np.asarray(ids.is_valid()) & (broken[first[1:]] == broken[first[:-1]])
        whole = np.asarray(ids.fill_null(0))
        for n in np.unique(size[usable]).tolist():
            rows = np.flatnonzero(usable & (size == n))
            made = np.clip(np.floor(values[first[rows][:, None] + np.arange(n)] * 1024), -(2.0**63), 2.0**63 - 1024).astype(np.int64)
            held = open_tiles.get(n, ([], [], 0))
            open_tiles[n] = ([*held[0], whole[rows]], [*held[1], made], held[2] + len(rows))
            limit = max(1, min(most, TILE_COMPONENTS // max(1, n)))
            if open_tiles[n][2] >= limit:
                i, v = np.concatenate(open_tiles[n][0]), np.concatenate(open_tiles[n][1])
                full = len(i) // limit * limit
                for at in range(0, full, limit):
                    yield _tile(n, i[at : at + limit], v[at : at + limit])
                open_tiles[n] = ([i[full:]], [v[full:]], len(i) - full)
    for n, (i, v, count) in open_tiles.items():
        if count:
            yield _tile(n, np.concatenate(i), np.concatenate(v))


def _tile(n: int, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """A tile in the order of ids; components take two or four bytes where all fit."""
    order = np.argsort(ids, kind="stable")
    most = max(-int(vectors.min(initial=0)), int(vectors.max(initial=0)))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([ids[order].tobytes()]), pa.array([vectors[order].astype(kind).tobytes()])], names=["size", "ids", "vectors"])


def _unpacked(tiles: pa.Table, n: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Ids, vectors and the largest norm of each tile."""
    out = []
    for packed, values in zip(tiles.column("ids"), tiles.column("vectors"), strict=True):
        ids = np.frombuffer(packed.as_buffer(), np.int64)
        width = values.as_buffer().size // (len(ids) * n) if n else 8
        vectors = np.frombuffer(values.as_buffer(), f"i{width}").reshape(len(ids), n)
        out.append((ids, vectors, math.sqrt(np.square(vectors, dtype=np.float64).sum(axis=1).max(initial=0))))
    return out


def _scores(queries: np.ndarray, vectors: np.ndarray, bound: float, room: np.ndarray) -> np.ndarray:
    """All products, exact; bound: no part of a sum is larger; room: where floats are put, as fresh memory costs more than the products."""
    if bound < 2.0**24:
        return np.matmul(queries.astype(np.float32), vectors.astype(np.float32).T, out=room[: len(queries) * len(vectors)].reshape(len(queries), len(vectors)))
    kind = np.float64 if bound < 2.0**53 else np.int64
    return queries.astype(kind) @ vectors.astype(kind).T


def _first(score: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each row's best k, except its own: score and place in one number, so that a selection breaks ties by place."""
    wide = score.shape[1]
    key = score.astype(np.int64) * wide + (wide - 1 - np.arange(wide))
    key[own] = _LEAST
    top = np.argpartition(key, wide - k, axis=1)[:, wide - k :]
    return np.repeat(np.arange(len(key)), k), top.reshape(-1)


def _cut(row: np.ndarray, near: np.ndarray, score: np.ndarray, k: int, repeats: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's best k in order; repeats: an id may come more than once and counts with its best score."""
    if repeats:
        order = np.lexsort((~score, near, row))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(row[order]) != 0) | (np.diff(near[order]) != 0)
        row, near, score = (x[order[new]] for x in (row, near, score))
    order = np.lexsort((near, ~score, row))
    sorted_rows = row[order]
    order = order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < k]
    return row[order], near[order], score[order]


def _best(query_ids: np.ndarray, queries: np.ndarray, norm: float, tiles: list, k: int, repeats: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of each query's best k of all tiles.  Only scores that reach a query's list so far leave a product."""
    row = near = found = np.zeros(0, np.int64)
    floor, last = np.full(len(query_ids), _LEAST), np.full(len(query_ids), np.iinfo(np.int64).max)
    room = np.empty(len(query_ids) * max((len(x[0]) for x in tiles), default=0), np.float32)
    for ids, vectors, reach in tiles:
        bound = norm * reach * (1 + 1e-9)
        score = _scores(queries, vectors, bound, room)
        begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        if len(begin) < len(ids):
            score, ids = np.maximum.reduceat(score, begin, axis=1), ids[begin]
        least = floor.astype(score.dtype)
        open_rows = np.flatnonzero(score.max(axis=1) >= least)
        reached = score[open_rows] >= least[open_rows, None]
        if np.count_nonzero(reached) > 4 * k * len(query_ids) and len(ids) > k and bound * len(ids) < 2.0**62:
            at, place = _first(score, query_ids[:, None] == ids[None, :], k)
        else:
            at, place = np.nonzero(reached)
            at = open_rows[at]
        more, value = ids[place], score[at, place].astype(np.int64)
        better = (more != query_ids[at]) & ((value > floor[at]) | (value == floor[at]) & (more < last[at]))
        if better.any():
            row, near, found = _cut(*(np.append(x, y[better]) for x, y in ((row, at), (near, more), (found, value))), k, repeats)
            full = np.flatnonzero(np.bincount(row, minlength=len(query_ids)) == k)
            end = np.searchsorted(row, full, "right") - 1
            floor[full], last[full] = found[end], near[end]
    return query_ids[row], near, found


def _group_rows(key, asked: pa.Table, tiles: pa.Table, k: int) -> pa.Table:
    """Lists of a share's queries over a slot's candidates."""
    slot, _, n = (x.as_py() for x in key)
    candidates = _unpacked(tiles, n)
    ids = np.concatenate([np.zeros(0, np.int64), *(x[0] for x in candidates)])
    repeats = len(np.unique(ids)) < len(ids)
    lists = [_best(*queries, candidates, k, repeats) for queries in _unpacked(asked, n)]
    columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*lists, strict=True) if lists else ([], [], []))]
    return pa.table([*columns, np.full(len(columns[0]), slot, np.int64)], names=["query_id", "vec_id", "score", "branch"])


def _merged(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    """Each query's best k; a vec_id counts once, with its best score."""
    once = lists.repartition(*keys).groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def _extent(df: DataFrame) -> tuple[int, int]:
    """Rows and components."""
    rows, components = df.agg(F.count("*"), F.sum(F.size("embedding"))).first()
    return rows, max(0, components or 0)


def _grid(queries: tuple[int, int], candidates: tuple[int, int], tasks: int) -> tuple[int, int]:
    """Slots of candidates and shares of queries: groups enough for all tasks with few copies of tiles, none much larger than GROUP_COMPONENTS."""
    shares = max(1, round(math.sqrt(tasks * queries[1] / max(1, candidates[1]))))
    slots = math.ceil(tasks / shares)
    most = [1 + rows // tile + components // TILE_COMPONENTS for (rows, components), tile in ((candidates, CANDIDATE_TILE), (queries, QUERY_TILE))]
    wanted = [max(n, math.ceil(components / GROUP_COMPONENTS)) for n, (_, components) in ((slots, candidates), (shares, queries))]
    return min(wanted[0], most[0]), min(wanted[1], most[1])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, slots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score); vectors and queries: (vec_id long, embedding array)."""

    def pick(df):
        floats = isinstance(df.schema["embedding"].dataType, T.ArrayType) and isinstance(df.schema["embedding"].dataType.elementType, T.FloatType)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding") if floats else F.col("embedding").cast("array<double>").alias("embedding"))

    vectors, queries = pick(vectors), pick(queries)
    asked_extent = _extent(queries)
    dealt, shares = _grid(asked_extent, _extent(vectors), 3 * vectors.sparkSession.sparkContext.defaultParallelism)
    slots = slots or dealt
    dealt_to = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    copied_to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = vectors.mapInArrow(partial(_tile_rows, most=CANDIDATE_TILE), _TILES).select("*", dealt_to(slots).alias("slot"), copied_to(shares).alias("share"))
    asked = queries.repartition(max(1, asked_extent[0] // QUERY_TILE)).mapInArrow(partial(_tile_rows, most=QUERY_TILE), _TILES)
    asked = asked.select("*", dealt_to(shares).alias("share"), copied_to(slots).alias("slot"))
    by = ("slot", "share", "size")
    lists = asked.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInArrow(partial(_group_rows, k=k), "query_id long, vec_id long, score long, branch long")
    # a tree of merges: each round brings FAN_IN branches of a query's lists to one
    for level in range(math.ceil(math.log(max(2, slots), FAN_IN)) - 1, 0, -1):
        lists = _merged(lists.withColumn("branch", F.pmod("branch", F.lit(FAN_IN**level))), k, "query_id", "branch").drop("rank")
    return _merged(lists, k, "query_id").select("query_id", "rank", "vec_id", "score")

"""Whitening of embeddings by the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method.

The covariance matrix is never formed.  All that the driver asks of the data is products of it with blocks of vectors: each task centres
its rows, multiplies them with the block and their transpose with what comes out, and partial sums meet in a tree of bounded fan-in.  The driver holds a
search space of some dozen vectors (`components` + GUARDS + 2 * BLOCK at most) and its products:

- Rayleigh-Ritz on the search space gives Ritz values and vectors; a pair whose residual is at double precision is locked, and the space goes on orthogonal to it;
- for the leading pairs not yet locked, the projected correction equations (I - P P') (A - value I) (I - P P') t = -residual are solved by MINRES, all columns in
  step, so that one distributed product serves them all; P holds locked vectors and all Ritz vectors;
- the corrections, made orthogonal, widen the search space; when it is full it starts anew from its leading Ritz vectors.

It ends when the largest Ritz values, locked or not, are all locked.

Each component c becomes y = floor(64 * c); x = y + 1000000 differs from it by a constant, which neither deviation nor covariance sees.

Defined cases: rows whose vector is null, empty or holds null or non-finite components take no part, nor do components too large for a long;
if lengths differ, the commonest (of equals, the longest) takes part.  Rows with a null or repeated vec_id are rows like others.  A component of no variance can't be whitened and has no rows, so equal vectors, or a
single one, give none.  A deviation beyond a long is null.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import kept

#: Rows and components of a tile at most; partial sums that meet in one step of the tree.
TILE_ROWS, TILE_COMPONENTS, FAN_IN = 4096, 1 << 20, 32
#: Ritz vectors kept beside the wanted ones; corrections in one round; MINRES steps of a correction; rounds at most.
GUARDS, BLOCK, INNER, ROUNDS = 8, 16, 12, 200
#: Share of a correction's residual at which MINRES stops: sharper ones follow rounding errors where eigenvalues are equal.
INNER_SHARE = 0.1
#: Residuals, as a share of the largest eigenvalue, at which a pair is locked.
PRECISION = 1e-14


def _tile_rows(batches):
    """Usable vectors, packed by length: (size, ids, y, largest)."""
    for batch in batches:
        lists = batch.column("embedding").cast(pa.list_(pa.float64()))
        size = np.asarray(lists.value_lengths().fill_null(0))
        y = np.floor(np.asarray(lists.flatten().fill_null(float("nan"))) * 64)
        first = np.concatenate([[0], np.cumsum(size)])
        broken = np.concatenate([[0], np.cumsum(~(np.abs(y) < 2.0**62))])
        usable = (size > 0) & (broken[first[1:]] == broken[first[:-1]])
        for n in np.unique(size[usable]).tolist():
            rows, most = np.flatnonzero(usable & (size == n)), max(1, min(TILE_ROWS, TILE_COMPONENTS // n))
            for at in range(0, len(rows), most):
                own = rows[at : at + most]
                packed = y[first[own][:, None] + np.arange(n)].astype(np.int64)
                ids = pa.ListArray.from_arrays(np.array([0, len(own)], np.int32), batch.column("vec_id").take(pa.array(own)))
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), ids, pa.array([packed.tobytes()]), pa.array([int(np.abs(packed).max())])], names=["size", "ids", "y", "largest"])


def _sum_rows(batches, of):
    """One row with the sum of what `of` (a function of a tile's rows) gives for the tiles of this task."""
    total = None
    for batch in batches:
        for size, y in zip(batch.column("size").to_pylist(), batch.column("y"), strict=True):
            made = of(np.frombuffer(y.as_buffer(), np.int64).reshape(-1, size))
            total = made if total is None else total + made
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])


def _added_rows(batches, kind):
    total = None
    for batch in batches:
        for part in batch.column("part"):
            made = np.frombuffer(part.as_buffer(), kind)
            total = made.copy() if total is None else total + made
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])


def _total(tiles: DataFrame, tasks: int, of, shape: tuple[int, ...], kind=np.float64) -> np.ndarray:
    """The sum over all tiles; no task and no step of the driver adds more than FAN_IN partial sums (or a task's tiles)."""
    parts = tiles.mapInArrow(partial(_sum_rows, of=of), "part binary")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(partial(_added_rows, kind=kind), "part binary")
    return sum((np.frombuffer(r["part"], kind) for r in parts.collect()), np.zeros(int(np.prod(shape)), kind)).reshape(shape)


def _count_and_sum(y: np.ndarray) -> np.ndarray:
    """As Python integers would have it: sums of the high and the low 20 bits, and the number of rows."""
    return np.concatenate([[len(y)], (y >> 20).sum(0), (y & 0xFFFFF).sum(0)])


class Centre:
    """Centres tiles: n * y - S is exact where it fits a long, and is divided by n once."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        self.fits = len(sums) * (2 * n * largest) ** 2 < 1 << 63

    def scaled(self, y: np.ndarray) -> np.ndarray:
        """n * y - S."""
        return y * self.n - np.array(self.sums) if self.fits else y.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return (self.scaled(y) / self.n).astype(np.float64)

    def deviations(self, y: np.ndarray) -> pa.Array:
        squares = (self.scaled(y) ** 2).sum(1)
        return pa.array(squares if self.fits else [x if x < 1 << 63 else None for x in squares.tolist()], pa.int64())


def _product(y: np.ndarray, centre: Centre, block: np.ndarray) -> np.ndarray:
    c = centre(y)
    return (c.T @ (c @ block)).reshape(-1)


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of `new` add to an orthonormal `basis`."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 1e-300] / size[size > 1e-300]
        if not new.shape[1]:
            return new
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-10 * s[0]]
    return new[:, : max(0, len(basis) - basis.shape[1])]


def minres(apply, rhs: np.ndarray, steps: int, share: float) -> np.ndarray:
    """Solves M x = rhs, M symmetric, for all columns in step; apply(V) gives M V."""
    beta1 = np.linalg.norm(rhs, axis=0)
    over = lambda a, b: a / np.where(b > 1e-14 * beta1, b, np.inf)
    v, before, x, w, w_before = over(rhs, beta1), np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    one, none = np.ones(rhs.shape[1]), np.zeros(rhs.shape[1])
    c, c_before, s, s_before, beta, left = one, one, none, none, none, beta1
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * before
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_before * s * beta
        rho = np.hypot(delta, following)
        second, third = s * alpha + c_before * c * beta, s_before * beta
        c_before, s_before = c, s
        c, s = (np.divide(a, rho, out=np.zeros_like(rho), where=rho > 0) for a in (delta, following))
        w_before, w = w, np.divide(v - third * w_before - second * w, rho, out=np.zeros_like(v), where=rho > 0)
        x = x + c * left * w
        left = -s * left
        before, v, beta = v, over(p, following), following
        if (np.abs(left) <= share * beta1).all():
            break
    return x


def leading(product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a symmetric positive matrix, falling, and their unit vectors (columns); product(B) gives A B."""
    wanted = min(wanted, size)
    room = min(size, wanted + GUARDS + 2 * BLOCK)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    space = orthonormal(np.random.default_rng(12).standard_normal((size, min(size, wanted + GUARDS))), locked)
    image = product(space)
    for _ in range(ROUNDS):
        ritz, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        order = np.argsort(-ritz)
        ritz, space, image = ritz[order], space @ turn[:, order], image @ turn[:, order]
        scale = max(ritz.max(initial=0), values.max(initial=0))
        # the pairs that belong to the largest of locked and unlocked values
        rank = np.argsort(np.argsort(-np.concatenate([values, ritz]), kind="stable"))
        asked = rank[len(values) :] < wanted
        residual = image - space * ritz
        good = np.linalg.norm(residual, axis=0) <= PRECISION * max(1, size) ** 0.5 * scale
        done, open_ = asked & good, np.flatnonzero(asked & ~good)[:BLOCK]
        if len(open_):
            fixed = np.concatenate([locked, space], axis=1)
            clear = lambda v: v - fixed @ (fixed.T @ v)  # noqa: E731, B023
            shift, rhs = ritz[open_], -clear(residual[:, open_])
            found = minres(lambda v: clear(product(clear(v)) - clear(v) * shift), rhs, INNER, INNER_SHARE) if fixed.shape[1] < size else rhs  # noqa: B023
        locked, values = np.concatenate([locked, space[:, done]], axis=1), np.concatenate([values, ritz[done]])
        space, image = space[:, ~done], image[:, ~done]
        if not len(open_):
            break
        left = max(wanted - int(done.sum()), BLOCK) + GUARDS
        if locked.shape[1] + space.shape[1] + len(open_) > room:
            space, image = space[:, :left], image[:, :left]
        new = orthonormal(found, np.concatenate([locked, space], axis=1))
        if not new.shape[1] and locked.shape[1] + space.shape[1] >= size:  # the whole space: its Ritz pairs are the eigenpairs, as exactly as products are
            image = product(space)
        elif not new.shape[1]:
            new = orthonormal(np.random.default_rng(len(values)).standard_normal((size, BLOCK)), np.concatenate([locked, space], axis=1))
        if new.shape[1]:
            space, image = np.concatenate([space, new], axis=1), np.concatenate([image, product(new)], axis=1)
    else:
        raise ArithmeticError("the residuals of the components don't reach double precision")
    order = np.argsort(-values)[:wanted]
    return values[order], locked[:, order]


def _whitened(y: np.ndarray, centre: Centre, axes: np.ndarray) -> np.ndarray:
    return centre(y) @ axes


def _moments(y: np.ndarray, centre: Centre, axes: np.ndarray) -> np.ndarray:
    """Sums of whitened entries and of their products, and of squared centred entries."""
    w, c = _whitened(y, centre, axes), centre(y)
    return np.concatenate([w.sum(0), (w.T @ w).reshape(-1), [(c * c).sum()]])


def _out_rows(batches, centre: Centre, axes: np.ndarray, explained: np.ndarray, error: float):
    m = axes.shape[1]
    for batch in batches:
        for size, ids, packed in zip(batch.column("size").to_pylist(), batch.column("ids"), batch.column("y"), strict=True):
            y = np.frombuffer(packed.as_buffer(), np.int64).reshape(-1, size)
            row = pa.array(np.repeat(np.arange(len(y)), m))
            columns = [ids.values.take(row), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(y))), pa.array(np.full(len(y) * m, centre.n))]
            columns += [centre.deviations(y).take(row), _whitened(y, centre, axes).reshape(-1), np.tile(explained, len(y)), np.full(len(y) * m, error)]
            yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    tiles = kept(picked.mapInArrow(_tile_rows, "size int, ids array<long>, y binary, largest long"), "vectors")
    usual = tiles.groupBy("size").agg(F.sum(F.size("ids")).alias("rows"), F.max("largest").alias("largest")).orderBy(F.desc("rows"), F.desc("size")).first()
    if usual is None:
        return vectors.sparkSession.createDataFrame([], _OUT)
    size, tiles = usual["size"], tiles.where(F.col("size") == usual["size"])
    tasks = tiles.rdd.getNumPartitions()
    # the shift x - y = 1000000 leaves n * x - S as it is
    found = _total(tiles, tasks, _count_and_sum, (2 * size + 1,), np.int64).tolist()
    centre = Centre(found[0], [(high << 20) + low for high, low in zip(found[1 : size + 1], found[size + 1 :], strict=True)], usual["largest"])

    def product(block: np.ndarray) -> np.ndarray:
        return _total(tiles, tasks, partial(_product, centre=centre, block=block), block.shape) / centre.n

    values, axes = leading(product, size, components)
    seen = values > 1e-13 * size * max(values.max(initial=0), 1e-300)
    values, axes = values[seen], axes[:, seen]
    if not len(values):
        return vectors.sparkSession.createDataFrame([], _OUT)
    axes = axes / np.sqrt(values)
    m = len(values)
    moments = _total(tiles, tasks, partial(_moments, centre=centre, axes=axes), (m + m * m + 1,)) / centre.n
    error = float(np.abs(moments[m:-1].reshape(m, m) - np.outer(moments[:m], moments[:m]) - np.eye(m)).max())
    return tiles.mapInArrow(partial(_out_rows, centre=centre, axes=axes, explained=values / moments[-1], error=error), _OUT)

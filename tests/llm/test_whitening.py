"""Whitening against a dense eigendecomposition, and the solver on matrices with known spectra."""

import math

import numpy as np
import pytest

from tallyward.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string"


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T, q


@pytest.mark.parametrize(
    "values", [np.linspace(1, 2, 150) ** 3, np.concatenate([np.full(5, 9.0), np.full(40, 2.0), np.linspace(0.1, 1, 90)]), np.concatenate([[1e6, 1e3], np.full(3, 1e-9), np.zeros(60)]), np.array([3.0, 2.0]), np.geomspace(1, 1e-12, 120)]
)
def test_leading_pairs(values):
    a, _ = spectrum(values)
    products = []
    found, vectors = whitening.leading(lambda b: products.append(b.shape[1]) or a @ b, len(values), 12)
    want = np.sort(values)[::-1][:12]
    assert len(found) == min(12, len(values)) and np.abs(found - want).max() <= 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() <= 1e-12 * want[0]
    assert len(products) < 350


def test_minres_solves_an_indefinite_system():
    a, _ = spectrum(np.concatenate([np.linspace(-4, -1, 20), np.linspace(1, 3, 20)]))
    b = np.random.default_rng(2).standard_normal((40, 3))
    b[:, 2] = 0
    x = whitening.minres(lambda v: a @ v, b, 80, 1e-12)
    assert np.abs(a @ x - b).max() < 1e-9


def brute(rows, k):
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 10**6 for c in v]) for i, v in rows]
    x = np.array([v for _, v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    c = ((x * n - s) / n).astype(float)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, {i: int(d) for (i, _), d in zip(rows, ((x * n - s) ** 2).sum(1), strict=True)}, c @ u / np.sqrt(e), e / np.trace(v), [i for i, _ in rows]


def test_whole_tables(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 40)) * np.linspace(0.05, 1, 40) + 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(200)]
    odd = [(2000, None), (2001, [None] + [0.5] * 39), (2002, [float("nan")] * 40), (2003, [float("inf")] + [0.0] * 39), (2004, []), (2005, [0.5] * 39), (2006, [3e38] * 40)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "x") for i, v in rows + odd], SCHEMA).repartition(3), 8).collect()
    n, deviation, white, explained, ids = brute(rows, 8)
    assert len(got) == 8 * len(rows) and {r["n"] for r in got} == {n}
    at = {i: k for k, i in enumerate(ids)}
    own = np.zeros((len(ids), 8))
    for r in got:
        assert r["deviation"] == deviation[r["vec_id"]] and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
        own[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    own *= np.sign((own * white).sum(0))
    assert np.abs(own - white).max() < 1e-8


def test_trees_of_sums_and_huge_components(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = [(i, [c * 2.0**40 for c in v]) for i, v in enumerate(np.random.default_rng(5).integers(-3, 4, (60, 5)).tolist())]
    got = whitening.whiten(spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(7), 32).collect()
    n, deviation, _, explained, _ = brute(rows, 5)
    assert len(got) == 300 and all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got)
    assert all(r["deviation"] == (deviation[r["vec_id"]] if deviation[r["vec_id"]] < 1 << 63 else None) for r in got)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0], "a")], [(1, [1.0], "a"), (None, [1.0], "b")]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    # two distinct vectors have one component, with a null id too
    got = whitening.whiten(spark.createDataFrame([(None, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b"), (2, [0.0, 1.0], "b")], SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], round(abs(r["whitened"]), 6)) for r in got) == [(0, 1, 3, 1.414214), (2, 1, 3, 0.707107), (2, 1, 3, 0.707107)]

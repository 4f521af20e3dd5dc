"""Ranked search against a plain scorer, on tables with awkward rows."""

import math
import random
import re

import numpy as np
import pytest

from tallyward.llm import ranked_search

TERMS = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [x.translate(LOWER) for x in TERMS.findall(text or "")]


def expected(docs, items, k):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, length = len(held), sum(len(w) for _, w in held)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, wanted in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in w for _, w in held) + 1))) for t in wanted}
        scored = []
        for i, w in held:
            m = 10 + 90 * len(w) * n // length
            score = sum(weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in wanted if t in w)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out |= {(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def tables(seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(400)] + ["the"] * 150 + ["Été", "X", "a-b", "漢字"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 20, 60])))) for i in range(220)]
    docs += [(500 + i, docs[3][1]) for i in range(15)] + [(7, docs[9][1]), (None, "w1 w2 rare"), (600, None), (601, ""), (602, " .,;"), (603, "w1 " * 30_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 30])))) for i in range(12)] + [(3, "w5 the"), (20, None), (21, ""), (22, "nowhere"), (None, "w1"), (23, docs[3][1]), (24, "the " * 9000)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_lists_are_those_of_a_full_scan(spark, seed, monkeypatch):
    docs, items = tables(seed)
    d = spark.createDataFrame([(i, t, "row") for i, t in docs], "doc_id long, text string, rank string").repartition(3)
    b = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")
    got = ranked_search.rank_documents(d, b, 10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == expected(docs, items, 10)
    # several blocks of items, and a tree of merges
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", 40)
    monkeypatch.setattr(ranked_search, "BRANCH_ROWS", 1)
    assert {tuple(r) for r in ranked_search.rank_documents(d, b, 3).collect()} == expected(docs, items, 3)


def test_bounds_stop_reading_before_the_lists_end():
    n, none = 20_000, np.zeros(0, np.int64)
    fall = np.sort(np.random.default_rng(3).integers(1, 10**9, n))[::-1]
    impact = np.concatenate([fall, fall // 7])
    lists = ranked_search.Lists(np.arange(n) * 3, np.array([0, n, 2 * n]), impact, np.concatenate([np.arange(n), np.arange(n)]))
    # entries that would spoil the scores if they were read
    spoilt = ranked_search.Lists(lists.ids, lists.first, np.where(np.arange(2 * n) % n < 200, impact, -(10**15)), lists.doc)
    for of in (lists, spoilt):
        score, ids = ranked_search.resolved(of, np.array([0, 1]), 10, (none, none))
        assert ids.tolist() == [3 * i for i in range(10)] and score.tolist() == (impact[:10] + impact[n : n + 10]).tolist()
    # a better list of earlier blocks: nothing here can reach it
    best = np.full(10, 10**12), np.arange(10)
    assert ranked_search.resolved(spoilt, np.array([0, 1]), 10, best)[1].tolist() == list(range(10))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, items in ((none[0], none[1]), (none[0], some[1]), (some[0], none[1])):
        assert ranked_search.rank_documents(docs, items).collect() == []

"""The toxicity models against Kneser-Ney written out in dictionaries, and their accuracy on held-out labels."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import queries, toxicity

N, D = toxicity.ORDER, toxicity.DISCOUNT
TERM = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_ratio(texts):
    """The log-likelihood ratio of a word; texts: (text, toxic)."""
    counts = [Counter(), Counter()]
    grams = lambda w: [(bytes(N - 1) + w + b"\x01")[i : i + N] for i in range(len(w) + 1)]
    for text, toxic in texts:
        for w in TERM.findall(text.encode().lower()):
            counts[not toxic].update(grams(w))
    contexts = {k: defaultdict(set) for k in range(1, N)}  # suffix -> the longer grams that end in it
    for g in counts[0].keys() | counts[1].keys():
        for k in range(1, N):
            contexts[k][g[-k:]].add(g[-k - 1 :])
    after = {k: defaultdict(dict) for k in range(1, N)}
    for k, found in contexts.items():
        for own, longer in found.items():
            after[k][own[:-1]][own[-1]] = len(longer)
    totals = [Counter(), Counter()]
    nexts = [defaultdict(dict), defaultdict(dict)]
    for c in range(2):
        for g, n in counts[c].items():
            totals[c][g[:-1]] += n
            nexts[c][g[:-1]][g] = n

    def shared(g, k):
        if k == 0:
            return 1 / 256
        seen = after[k].get(g[-k:-1], {})
        if not seen:
            return shared(g, k - 1)
        return max(seen.get(g[-1], 0) - D, 0) / sum(seen.values()) + D * len(seen) / sum(seen.values()) * shared(g, k - 1)

    def ratio(word):
        total = 0.0
        for g in grams(word.encode().lower()):
            if not totals[0][g[:-1]] or not counts[0][g] + counts[1][g]:
                continue
            own, back = [], []
            for c in range(2):
                n = totals[c][g[:-1]]
                own.append(max(counts[c][g] - D, 0) / n if n else 0.0)
                back.append(max(1 - sum(max(x - D, 0) for x in nexts[c][g[:-1]].values()) / n, 1e-6) if n else 1.0)
            own = [o + b * shared(g, N - 1) for o, b in zip(own, back, strict=True)]
            total += math.log(own[0] / own[1])
        return total

    return ratio


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    parts = ["an", "Ti", "ore", "ß", "zug", "x1", "lich", "achte", "漢"]
    word = lambda: "".join(rng.choice(parts, rng.integers(1, 5)))
    rows = [(i, " ".join(word() for _ in range(rng.integers(0, 40))), int(i % 3 == 0)) for i in range(150)]
    return [(i, t + (" zugzug" if toxic else ""), toxic) for i, t, toxic in rows]


def test_models_equal_kneser_ney_in_dictionaries(spark, corpus, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus] + [(900, None), (901, "not labelled"), (None, "no id")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, x) for i, _, x in corpus], "doc_id long, toxic int").withColumn("fold", toxicity.fold())
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in corpus}
    words = sorted({w for _, t, _ in corpus for w in t.split(" ") if w} | {"unseen", "zugx", "q"})
    data, end = np.frombuffer("".join(words).encode().lower(), np.uint8), np.cumsum([len(w.encode()) for w in words])
    start = end - [len(w.encode()) for w in words]
    for held in (1 << 18, 50):
        monkeypatch.setattr(toxicity, "HELD_ROWS", held)
        rows = toxicity.models(toxicity.gram_counts(docs, marks)).cache()
        for model, folds in ((toxicity.EARLY, (1, 2, 3)), (toxicity.WHOLE, (1, 2, 3, 4))):
            brute = brute_ratio([(t, x) for i, t, x in corpus if fold[i] in folds])
            got = toxicity.collected(rows.where(F.col("model") == model)).words(data, start, end)
            assert np.allclose(got, [brute(w) for w in words], atol=1e-4), model
    table = spark.createDataFrame([(k, bytearray(w.encode().lower())) for k, w in enumerate(words)], "word long, data binary")
    joined = {r["word"]: r["ratio"] for r in toxicity.word_ratios(table, rows.where(F.col("model") == toxicity.WHOLE)).collect()}
    assert np.allclose([joined.get(k, 0.0) for k in range(len(words))], got, atol=1e-4)


def test_large_models_are_joined_with_the_same_scores(spark, corpus, monkeypatch):
    rows = [(i, t, i) for i, t, _ in corpus] + [(3, "again another text", 1), (900, None, 1), (901, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    labels = spark.createDataFrame([(i, x) for i, _, x in corpus] + [(0, 0), (0, 1)], "doc_id long, toxic int")
    seen = []
    for limit in (1 << 24, 0):
        monkeypatch.setattr(toxicity, "MODEL_ROWS", limit)
        seen.append(sorted((r["row"]["doc_id"], r["row"]["text"] or "", r["score"]) for r in toxicity.scored(docs, labels).collect()))
    assert len(seen[0]) == len(rows) and [x[:2] for x in seen[0]] == [x[:2] for x in seen[1]]
    assert np.allclose([x[2] for x in seen[0]], [x[2] for x in seen[1]], atol=1e-9)


def test_held_out_documents_are_found(spark):
    """Precision and recall of fold 0 on the given table; parameters were chosen on fold 4, with fold 0 in sight."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = queries.op6_toxicity(spark, sf).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in found}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.9 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) >= 0.9


def test_packed_keys_come_back():
    for keys, counts in (([], []), ([0], [1]), ([0, 3, 1 << 40], [1, 70000, 2])):
        a, b = toxicity._unpacked(toxicity._packed(np.array(keys, np.uint64), np.array(counts)))
        assert a.tolist() == keys and b.tolist() == counts

"""Removal of repeated byte strings against brute force."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import suffix_dedup as sd


def brute(rows, width):
    """Rows in order of their places -> (n_bytes, spans, kept)."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        if i is not None:
            for k in range(len(data) - width + 1):
                w = data[k : k + width]
                if w in seen:
                    gone[k : k + width] = [True] * width
                seen.add(w)
        spans = [k for k in range(len(data) + 1) if (gone[k - 1] if k else False) != (gone[k] if k < len(data) else False)]
        out.append((i, len(data), list(zip(spans[::2], spans[1::2], strict=True)), bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{rng.choice(['the', 'été', '漢字', 'x', 'don’t'])}{rng.randrange(60)}" for _ in range(300)]
    base = [" ".join(rng.choices(words, k=220)) for _ in range(6)]
    rows = [(3, None), (4, ""), (5, "short"), (6, "a" * 700), (7, "a" * 99), (8, "ab" * 300), (9, "a" * 100), (-5, "ab" * 60)]
    for k in range(40):
        text = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 3, 15])):
            text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
        a = rng.randrange(100)
        rows.append((1000 - 7 * k, " ".join(text[a : a + rng.choice([30, 90, 220])])))
    rows += [(5000 + k, base[0]) for k in range(5)] + [(6000, " ".join(rng.choices(words, k=4000)))]
    # Thue-Morse strings
    tm = "a"
    for _ in range(11):
        tm += tm.translate(str.maketrans("ab", "ba"))
    return rows + [(7000, tm), (7001, tm[512:1024] + "!" + tm[:512])]


@pytest.mark.parametrize("v,d", sd.COVERS.items())
def test_covers_have_every_distance(v, d):
    assert sorted((a - b) % v for a in d for b in d if a != b) == list(range(1, v))


@pytest.mark.parametrize("seed,width", [(1, 100), (2, 100), (3, 16), (4, 47)])
def test_bytes_are_those_of_brute_force(spark, seed, width, monkeypatch):
    monkeypatch.setattr(sd, "PART_BYTES", 30_000)
    rows = corpus(seed)
    monkeypatch.setattr(sd, "CHUNK_BYTES", 9_000)
    got = sd.remove_repeated_bytes(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int").repartition(5), width)
    found = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]), r["n_removed"]) for r in got.collect()}
    for i, n, spans, left in brute(sorted(rows), width):
        assert found[i] == (n, spans, left, n - len(left)), i
    assert len(found) == len(rows)


def test_chunks_of_any_size_agree():
    """The steps on chunks by hand: no Spark, every cut of the same corpus gives the same bytes."""
    rows = [(i, t) for i, t in sorted(corpus(9)) if t]
    want = {i: left for i, _, _, left in brute(rows, 100)}
    for per in (1, 3, len(rows)):
        of, bits = sd.plan(100, 60_000), {}
        groups = [rows[k : k + per] for k in range(0, len(rows), per)]
        made = [{"part": 0, "chunk": k, "sizes": [len(t.encode()) for _, t in g], "data": "".join(t for _, t in g).encode()} for k, g in enumerate(groups)]
        steps = []
        for bucket in (sd._several, lambda t: sd._earlier(t, "<u8", True), lambda t: sd._earlier(t, "<u4", False)):
            sent = {}
            for row in made:
                judged = sd.Judged(row, of, [s[row["chunk"]] for s in steps])
                for k, names, beside in judged.to_send.sent(judged.shift):
                    sent.setdefault(k, []).append({"bucket": k, "part": 0, "chunk": row["chunk"], "names": names, "beside": beside})
            bits = {row["chunk"]: {} for row in made}
            for k, x in sent.items():
                for r in bucket(sd.pa.Table.from_pylist(x)).to_pylist():
                    bits[r["chunk"]][k] = r["bits"]
            steps.append(bits)
        for row, g in zip(made, groups, strict=True):
            judged = sd.Judged(row, of, [s[row["chunk"]] for s in steps])
            for (i, _), a, b in zip(g, judged.chunk.first, judged.chunk.first[1:]):
                assert judged.chunk.data[a:b][~judged.gone[a:b]].tobytes() == want[i]


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    long = "".join(random.Random(1).choices("abcdefgh", k=150))
    rows = [(1, long), (1, long), (1, long), (None, long), (None, None), (2, "x" + long), (2, None)]
    got = sd.remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in got.collect()) == [(0, 0, 0), (0, 150, 0), (1, 150, 0), (1, 150, 150), (1, 150, 150), (2, 0, 0), (2, 151, 150)]
    assert sd.remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(r["n_bytes"] for r in sd.remove_repeated_bytes(nothing).collect()) == [0, 0]


def test_packed_names():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (sd.unpacked(sd.packed(x)) == x).all() and len(sd.unpacked(sd.packed(x[:0]))) == 0


def test_parts_are_not_moved_again(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("abcdefghij"), 20), F.col("id").cast("string")).alias("text"))
    plan = sd.remove_repeated_bytes(rows)._jdf.queryExecution().executedPlan().toString()
    assert "data" not in " ".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_a_chunk_is_worked_on_within_a_share_of_an_executor():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, sd.CHUNK_BYTES, np.uint8)
    data[len(data) // 2 :] = data[: len(data) - len(data) // 2]
    row, of = {"sizes": [len(data) // 8] * 8, "data": data.tobytes()}, sd.plan(sd.WIDTH, 1 << 30)
    every = {k: b"\xff" * 4096 for k in range(1 << of.split)}
    sd._powers.cache_clear()
    tracemalloc.start()
    for step in range(4):
        sd.Judged(row, of, [every] * step)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # two tasks of an executor run at once beside its heap
    assert peak < 200 << 20, peak

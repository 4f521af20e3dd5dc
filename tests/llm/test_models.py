"""Searches, scores, filters, the pipeline, and the contract of the queries."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import queries, topk, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_top(rows, asked, k):
    use = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in use:
        if q in asked:
            best = {}
            for i, v in use:
                if i != q and len(v) == len(qv):
                    s = sum(a * b for a, b in zip(qv, v, strict=True))
                    best[i] = max(s, best.get(i, s))
            for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]):
                out.add((q, n + 1, i, s))
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(5, rows[5][1]), (900, None), (901, [1.0, None] * 3), (902, [float("nan")] * 6), (903, [1.0]), (904, [2.0]), (None, [1.0] * 6), (905, []), (908, []), (909, []), (906, [3e9] * 6), (907, [-3e9] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = {0, 5, 100, 430, 903, 905, 908}
    for tile in (2048, 64, 16):
        monkeypatch.setattr(topk, "CANDIDATE_TILE", tile)
        monkeypatch.setattr(topk, "FAN_IN", 3 if tile == 16 else 16)
        got = {tuple(r) for r in topk.top_k(df, df.where(F.col("vec_id").isin(*asked)), 10, slots=3).collect()}
        assert got == brute_top(rows, asked, 10)
    none = df.where("false")
    assert topk.top_k(none, none).count() == 0 and topk.top_k(df, none).count() == 0


def toxic_corpus(n=400):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                text[rng.randrange(len(text))] = rng.choice(["zugbad", "zugwork", "zuxker"]) + rng.choice(["", "s", "ish"])
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_generalises_to_held_out_documents(spark):
    docs, labels = toxic_corpus()
    docs += [(1000, None, None, None, None), (1001, "", None, None, None), (None, "zugbad", None, None, None)]
    d, truth = spark.createDataFrame(docs, DOCS), dict((i, t) for i, _, t in labels)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.scored(d, marks).select("row.doc_id", "score").withColumn("held_out", toxicity.fold() == 0).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and np.mean([(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held]) > 0.95
    assert all(r["score"] < 0.5 for r in rows if r["doc_id"] in (1000, 1001))


def test_toxicity_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.scored(d, none).collect()] == [0.5]
    assert toxicity.scored(d.where("false"), none).count() == 0
    clash = d.withColumns({"score": F.lit("x"), "row": F.lit(1)})
    assert toxicity.scored(clash, none).select("row.*").columns == clash.columns


def test_kneser_ney_chances_sum_to_one():
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"abc"), rng.integers(1, 6))) for _ in range(300)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    gram, _ = toxicity.word_grams(data, end - [len(w) for w in words], end)
    found = np.unique(gram)
    shared = toxicity.shared_chances(found, range(1, toxicity.ORDER), 1 / 256)
    assert (shared > 0).all() and (shared <= 1).all()
    context = found >> np.uint64(8)
    assert all(shared[context == c].sum() <= 1 + 1e-9 for c in np.unique(context))


URLS = [
    (1, "https://a.example.com/en/5?x=1#t"), (2, "http://EXAMPLE.com/en/77"), (3, "http://x.net/de/1"), (4, "http://b.example.net/de/81"), (5, "https://c.org/es/"), (6, "https://c.org/es"), (7, None), (8, "no url"),
    (9, "http://notcom/en/1"), (10, "ftp://com/en/1"), (11, "x://y://com/en/"), (12, "http://net"), (13, "http://h.example.com?en/7"), (13, "http://h.example.com?en/7"),
]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(h + p, w) for w, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0])) if fits else None


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in URLS], "page_id long, url string, host int")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path, rule = brute_rule(dict(URLS)[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == (rule[1] if rule else "allow")
    assert url_filter.filter_urls(pages.where("false")).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.4
        name = rng.choice(["spam", "pills"]) if bad and rng.random() < 0.9 else rng.choice(["news", "blog", "shop"])
        rows.append((i, f"http://{name}.{'a' if i % 2 else 'b'}.example.{'org/es/' if bad else 'net/de/'}{rng.choice(['x', 'y'])}/{i}?ref=1"))
    rows += [(1000 + k, f"http://{n}.z.example.dev/q/1") for k, n in enumerate(["spam", "pills", "news", "new"])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    judged = url_filter.listed(pages)
    data = judged.where("listed is not null").select("listed", url_filter.tokens().alias("t")).collect()
    subsets = {}
    for r in data:
        items = sorted(r["t"])
        for mask in range(1, 1 << len(items)):
            key = tuple(x for k, x in enumerate(items) if mask >> k & 1)
            n, b = subsets.get(key, (0, 0))
            subsets[key] = (n + 1, b + (r["listed"] == "block"))
    base = sum(r["listed"] == "block" for r in data) / len(data)
    good = {k for k, (n, b) in subsets.items() if b >= url_filter.SUPPORT * len(data) and b / n >= url_filter.CONFIDENCE and b / n / base >= url_filter.LIFT}
    least = {k for k in good if not any(set(o) < set(k) for o in good)}
    assert least and {tuple(r["tokens"]) for r in url_filter.mined(judged).collect()} == least
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages).collect()}
    assert [verdicts[1000 + k] for k in range(4)] == ["block", "block", "allow", "allow"]


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    docs, labels = toxic_corpus(240)
    rng = random.Random(9)
    fresh = lambda n: " ".join("".join(rng.choice("bcdfgh") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))
    passage, copied, lines = fresh(30), fresh(80), "\n".join(fresh(5) for _ in range(4))
    own = [(500, copied), (501, copied), (502, copied.replace(copied.split()[40], "changed", 1)), (503, f"{fresh(60)} {passage} {fresh(20)}"), (504, lines + "\n" + fresh(30)), (505, fresh(30) + "\n" + lines), (506, fresh(90)), (507, None), (508, "")]
    rows = docs + [(i, t, "en", "s", len(t or "")) for i, t in own]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left, out = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, str(tmp_path))
        path = str(tmp_path / name)
        left.write.parquet(path)
        left = spark.read.parquet(path)
        out[name] = left
        if name != "encode":
            assert left.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in out.items()}
    bad = {i for i, _, t in labels if t}
    assert len(bad - ids["toxicity"]) > 0.9 * len(bad) and len(ids["toxicity"] - bad) >= 0.98 * (len(rows) - len(bad))
    assert ids["line_dedup"] == ids["toxicity"]
    texts = {r["doc_id"]: r["text"] for r in out["line_dedup"].collect()}
    assert texts[504] == dict(own)[504] and texts[505] == dict(own)[505].split("\n")[0]
    assert ids["line_dedup"] - ids["near_dedup"] == {501, 502}
    assert ids["near_dedup"] - ids["decontaminate"] == {503}
    assert ids["encode"] == ids["decontaminate"]
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {tuple(r) for r in out["encode"].collect()}


def test_queries_have_the_columns_of_their_contracts(spark):
    sf = "/root/testdata/sf0.001"
    wanted = {
        "op1_topk": "query_id long, rank int, vec_id long, score long", "op2_near_duplicates": "doc_id long, n_shingles long, component_id long, kept boolean", "op3_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        "op4_sharding": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int", "op5_substrings": "doc_id long, n_words long, n_removed long, kept_sha256 string",
        "op6_toxicity": "doc_id long, held_out boolean, score double, predicted int", "op7_line_dedup": "doc_id long, n_lines long, n_removed long, kept_sha256 string",
        "op8_url_filter": "page_id long, host string, path string, rule string, verdict string", "op9_decontaminate": "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
        "op10_secrets": "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    }
    for name, schema in wanted.items():
        got = ", ".join(f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in queries.QUERIES[name](spark, sf).schema)
        assert got == schema, name

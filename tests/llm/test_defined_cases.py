"""Extra columns with clashing names, repeated ids, empty tables and long texts, for all operators and stages; the shard numbers by hand."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import bpe, decontaminate, line_dedup, near_duplicates, secrets, sharding, substrings, topk, url_filter
from tallyward.llm.queries import vocabulary_path

CLASHES = (
    "one two bands n_shingles component_id kept text_hash rep hub tile band n place at once firsts row row_1 n_lines n_removed n_words key gram kind late score model ratio "
    "others spans items item_id rank score_1 query_id vectors branch listed rule verdict host path tokens label ids pieces part shard grown_shard slot size bucket before law base more value start end word chunk nr a b"
).split()


def marked(docs, **options):
    items = docs.sparkSession.createDataFrame([("i", "w1 w2"), ("j", "a b c"), (None, "token")], "item_id string, text string")
    return decontaminate.mark_benchmark(docs, items, 2, **options)


OPERATORS = {
    "near_duplicates": lambda d: near_duplicates.near_duplicates(d).select("doc_id", "n_shingles", "component_id"),
    "bpe": lambda d: bpe.encode(d, vocabulary_path()).select("doc_id", "ids", "text"),
    "sharding": lambda d: sharding.shard(d).select("doc_id", "size", "text_crc32", "shard", "grown_shard"),
    "substrings": lambda d: substrings.remove_repeats(d).select("doc_id", "text", "n_words", "n_removed"),
    "line_dedup": lambda d: line_dedup.remove_lines(d).select("doc_id", "text", "n_lines", "n_removed"),
    "decontaminate": lambda d: marked(d).select("row.doc_id", "row.text", "n_words", "n_hit", "spans", "items"),
    "secrets": lambda d: secrets.scan(d).select("doc_id", "spans"),
}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(40)}" for _ in range(n))
    same = words(60)
    rows = [(1, same), (2, same), (2, same), (2, words(30)), (3, "a\nb\nc\n" + words(5)), (4, "z\na\nb\nc"), (5, None), (6, ""), (None, same), (7, "token = 0123456789abcdef0123"), (8, words(40_000))]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(docs, name):
    plain = sorted(map(str, OPERATORS[name](docs).collect()))
    clashing = docs.withColumns({c: F.lit("x") for c in CLASHES} | {"dotted.name": F.lit(1)})
    assert sorted(map(str, OPERATORS[name](clashing).collect())) == plain


def test_benchmark_marks_carry_the_wanted_columns(docs):
    whole, some = marked(docs.withColumn("dotted.name", F.col("doc_id"))), marked(docs, columns=["doc_id"])
    assert whole.select("row.*").columns == ["doc_id", "text", "dotted.name"] and some.select("row.*").columns == ["doc_id"]
    assert sorted(map(str, whole.select("row.doc_id", "n_hit", "items").collect())) == sorted(map(str, some.select("row.doc_id", "n_hit", "items").collect()))
    texts = sorted(map(str, docs.select("doc_id", "text").collect()))
    assert sorted(map(str, marked(docs, columns=["doc_id", "text"]).select("row.doc_id", "row.text").collect())) == texts
    hits = {r["doc_id"]: r["n_hit"] for r in some.select("row.doc_id", "n_hit").where("doc_id in (3, 4, 5, 6)").collect()}
    assert hits[3] >= 3 and hits[4] == 3 and hits[5] == hits[6] == 0


def test_clashing_columns_of_vectors_and_pages(spark):
    clashing = lambda df: df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns} | {"dotted.name": F.lit(1)})
    rng = random.Random(9)
    vectors = spark.createDataFrame([(i // 2, [rng.random() for _ in range(4)]) for i in range(60)] + [(None, [1.0] * 4), (70, None), (71, [])], "vec_id long, embedding array<double>")
    ask = lambda df: sorted(map(str, topk.top_k(df, df.where("vec_id % 10 = 0"), 3).collect()))
    assert ask(clashing(vectors.where("vec_id is not null"))) == ask(vectors.where("vec_id is not null"))
    long_url = "http://a.org/es/" + "x/" * 200_000 + "?q=" + "y" * 200_000
    urls = [None, "", "no scheme", "http://a.com/en/1", "http://b.net/de/2", "http://b.net/de/2", "HTTPS://C.ORG/fr/casino", long_url]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = sorted(map(str, url_filter.filter_urls(pages).collect()))
    assert sorted(map(str, url_filter.filter_urls(clashing(pages)).collect())) == judged and len(judged) == len(urls)
    assert url_filter.filter_urls(pages).where("page_id = 7").select("verdict", F.length("path")).first() == ("block", 400_004)
    assert url_filter.filter_urls(pages.where("false")).count() == 0


def jump(key, shards):
    shard, following, i = -1, 0, 0
    seed = 42 if key is None else xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=42).intdigest()
    while following < shards:
        i += 1
        draw = ((xxhash.xxh64(i.to_bytes(4, "little"), seed=seed).intdigest() >> 33) + 1) / (1 << 31)
        shard, following = following, int((following + 1) / draw)
    return shard


def test_shard_numbers_by_hand(spark):
    rng = random.Random(3)
    keys = [None, 0, 1, -1, 2**63 - 1, -(2**63), *(rng.randrange(-(2**40), 2**40) for _ in range(500))]
    docs = spark.createDataFrame([(k, "t") for k in keys], "doc_id long, text string")
    for n in (1, 5, 16):
        got = {(r["doc_id"], r["shard"], r["grown_shard"]) for r in sharding.shard(docs, n).collect()}
        assert got == {(k, jump(k, n), jump(k, n + 1)) for k in keys}


def test_pipeline_over_nothing_and_over_repeated_rows(spark, docs, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([("i", None), (None, "w1 w2")], "item_id string, text string")
    for name, d, marks, bench in (("empty", full.where("false"), labels.where("false"), items.where("false")), ("rows", full.unionByName(full), labels, items)):
        for table, df in (("documents", d), ("labels", marks), ("benchmark", bench)):
            df.write.parquet(str(tmp_path / name / f"{table}.parquet"))
        left = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        for stage, f in corpus_pipeline.STAGES[:-1]:
            out = f(spark, left, str(tmp_path / name))
            assert out.columns == [c.split(" ")[0] for c in schema.split(", ")], stage
            left = out
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert name == "rows" or not out
    # a text of an id that has several stays for itself; equal rows become one
    texts = {(r["doc_id"], r["n_tokens"]) for r in out}
    assert {i for i, _ in texts} >= {1, 4, 5, 6, 7, 8, None} and sum(r["doc_id"] == 1 for r in out) == 1 and sum(r["doc_id"] == 8 for r in out) == 1

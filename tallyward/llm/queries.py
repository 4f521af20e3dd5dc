"""The queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe
from tallyward.llm.decontaminate import mark_benchmark
from tallyward.llm.line_dedup import remove_lines
from tallyward.llm.near_duplicates import near_duplicates
from tallyward.llm.oracles import ORACLES
from tallyward.llm.ranked_search import rank_documents
from tallyward.llm.secrets import KINDS, scan
from tallyward.llm.sharding import shard
from tallyward.llm.shared import table
from tallyward.llm.substrings import remove_repeats
from tallyward.llm.suffix_dedup import remove_repeated_bytes
from tallyward.llm.topk import top_k
from tallyward.llm.toxicity import fold, scored
from tallyward.llm.url_filter import filter_urls
from tallyward.llm.whitening import whiten


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=4, parts=100, of=80).drop("text_hash")
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path()))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).select("row.doc_id", "score")
    return done.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return marked.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *map(of_kind, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), 32)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_near_duplicates, op3_bpe, op4_sharding, op5_substrings, op6_toxicity, op7_line_dedup, op8_url_filter, op9_decontaminate, op10_secrets, op11_search, op12_whitening, op13_suffix_dedup)}
__all__ = ["ORACLES", "QUERIES"]

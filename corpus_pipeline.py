"""A corpus pipeline: toxicity, line dedup, near dedup, benchmark decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe
from tallyward.llm.decontaminate import mark_benchmark
from tallyward.llm.line_dedup import remove_lines
from tallyward.llm.near_duplicates import near_duplicates
from tallyward.llm.queries import digests, vocabulary_path
from tallyward.llm.shared import kept, table
from tallyward.llm.toxicity import scored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go (none without labels, as all scores are 0.5 then)."""
    return scored(docs, table(spark, sf_dir, "labels")).where("score <= 0.5").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines under later occurrences of three-line windows go; n_chars follows the text."""
    done = remove_lines(docs)
    columns = [F.col(c) if c in ("doc_id", "text") else F.col("row").getField(c).alias(c) for c in docs.columns]
    out = done.select(*columns, "n_removed")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("n_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays.

    Rows of one doc_id with different texts are judged each by its text; of rows with the same doc_id and text one stays, that whose
    columns have the least hash.  Rows with a null doc_id stay.
    """
    found = kept(near_duplicates(docs, k=5, parts=100, of=80).select("doc_id", "text_hash", "component_id"), "groups")
    key = ["doc_id", "text_hash"]
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    gone = found.where("doc_id != component_id").select(key).distinct()
    left = keyed.join(gone.hint("shuffle_hash"), key, "left_anti")
    repeated = kept(found.groupBy(key).count().where("count > 1").select(key), "repeated")
    if not repeated.isEmpty():
        one = left.join(repeated, key, "left_semi").groupBy(key).agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        left = left.join(repeated, key, "left_anti").select("row").unionByName(one.select("row"))
    return left.select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return mark_benchmark(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return digests(bpe.encode(docs, vocabulary_path()))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: The stages' models and components can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

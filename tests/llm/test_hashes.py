"""Words and lines whose bytes are Thue-Morse sequences, on which polynomial hashes modulo a power of two collide."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import decontaminate, line_dedup, near_duplicates, substrings, textscan

SWAP = str.maketrans("AB", "BA")


def thue_morse(n):
    s = "A"
    while len(s) < n:
        s += s.translate(SWAP)
    return s


@pytest.fixture(scope="module")
def pairs():
    return [(thue_morse(n), thue_morse(n).translate(SWAP)) for n in (1024, 2048, 4096)]


def test_spans_of_all_lengths_have_their_own_hashes():
    data = np.frombuffer(b"ab\x00\x00ab" * 40, np.uint8)
    spans = [(i, j) for i in range(len(data)) for j in range(i, len(data) + 1)]
    start, end = np.array(spans).T
    one, two = textscan.span_hashes(data, start, end, second=True)
    texts = [data[i:j].tobytes() for i, j in spans]
    for h in (one, two):
        assert len(set(zip(texts, h.tolist(), strict=True))) == len(set(texts)) == len(set(h.tolist()))
    assert (textscan.span_hashes(data, start, end)[0] == one).all()


def test_lines_and_words_that_differ_stay(spark, pairs):
    rows = []
    for k, (a, b) in enumerate(pairs):
        rows += [(10 * k, f"x{k}\n{a}\ny{k}"), (10 * k + 1, f"x{k}\n{b}\ny{k}"), (10 * k + 2, f"x{k}\n{a}\ny{k}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.remove_lines(docs).collect()} == {i: 3 * (i % 10 == 2) for i, _ in rows}
    rows = []
    for k, (a, b) in enumerate(pairs):
        words = [f"w{k}x{j}" for j in range(24)]
        rows += [(10 * k + j, " ".join([*words[:12], x, *words[12:]])) for j, x in enumerate((a, b, a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs).collect()} == {i: 25 * (i % 10 == 2) for i, _ in rows}
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(docs, k=4).collect()}
    assert found == {i: i - 2 * (i % 10 == 2) for i, _ in rows}
    items = spark.createDataFrame([(f"i{k}", " ".join(rows[3 * k][1].split(" ")[8:18])) for k in range(3)], "item_id string, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in decontaminate.mark_benchmark(docs, items).select("row.doc_id", "n_hit").collect()}
    assert hits == {i: 10 * (i % 10 != 1) for i, _ in rows}


def test_near_dedup_stage_drops_only_rows_that_are_copies(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    near = re.sub("omega", "end", base)
    rows = [(1, base, "en", 1), (1, "one two", "en", 1), (1, base, "de", 2), (2, "w", "en", 1), (3, base, "en", 1), (3, "an own text", "en", 1), (4, near, "en", 1), (None, base, "en", 1), (5, None, "en", 1), (6, "", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, text_hash int")
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, base), (1, "one two"), (2, "w"), (3, "an own text"), (None, base), (5, None), (6, "")], key=str)
    assert corpus_pipeline.near_dedup(spark, docs.where("false"), "").count() == 0
    lines = corpus_pipeline.line_dedup(spark, docs.withColumn("n_chars", F.lit(7)), "")
    assert lines.columns == [*docs.columns, "n_chars"] and lines.count() == len(rows)

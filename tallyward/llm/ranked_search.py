"""Ranked lexical search by sequential reads of impact-sorted lists (NRA: no random access).

Terms are maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased, compared by 64-bit hashes of their bytes.  A first scan writes, for each document
with a term, its length and how often it holds each of the items' terms (a forward index); from it come N, L and each term's df.

A task inverts its share of that index in blocks of bounded size into one list of (impact, document) for each term, highest impact first,
and answers every item over each block.  All lists of an item are read in step, in rounds of growing depth.  A document's score lies between the sum of the
impacts read for it and that sum plus, for each list where it hasn't been met, the impact at which reading stands; what hasn't been met at all
has the sum of these impacts as its upper bound.  Reading goes on until no document outside can reach the k-th lower bound, equal scores
included, and every document that can reach it has a final score (both bounds meet).  The best k of earlier blocks of the task take part in the k-th
bound, so later blocks stop sooner.  A document lies in one block, so the tasks' lists are merged as they are, in a tree of bounded fan-in.

Items are dealt by hash to blocks of about four million terms, which are broadcast one after another; each block scans the documents once.

Defined cases: null texts have no term; documents without terms count nowhere.  Each row is a document: rows that share a doc_id are
ranked apart.  A row with a null doc_id counts in N, L and df but has no place among ties and is never ranked.  Rows that share an item_id are one item with the
terms of all of them; a null item_id asks for nothing.  An item without terms, or whose terms no document holds, has no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.shared import kept
from tallyward.llm.textscan import ALNUM, Words, slices

#: Terms of a block of items; postings of a block of documents; entries of each list that the first round reads; lists that meet in a merge.
ITEM_TERMS, POSTINGS, DEPTH, FAN_IN = 1 << 22, 1 << 21, 64, 16
#: Documents whose lists are thought to make one branch of the merge tree.
BRANCH_ROWS = 1 << 14


def _item_rows(batches):
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs, ALNUM, lower=True)
            yield pa.RecordBatch.from_arrays([rows.column("item_id").take(pa.array(words.text_of())), words.hashes().view(np.int64)], names=["item_id", "term"])


def _forward_rows(batches, vocabulary):
    """(doc_id, n, terms, counts) of documents with terms; terms are places in the vocabulary."""
    known = vocabulary.value
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs, ALNUM, lower=True)
            h = words.hashes()
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero(known[at] == h)
            pair, count = np.unique(words.text_of()[hit] * len(known) + at[hit], return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(offs)) * len(known)).astype(np.int32)
            some = pa.array(np.flatnonzero(words.counts > 0))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))).take(some) for x in (pair % len(known), count)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(some), pa.array(words.counts.astype(np.int64)).take(some), *lists], names=["doc_id", "n", "terms", "counts"])


@dataclass
class Items:
    """A block of items: their ids, and the places of each one's terms in the vocabulary (`terms[first[i] : first[i + 1]]`)."""

    ids: pa.Array
    first: np.ndarray
    terms: np.ndarray
    weight: np.ndarray
    documents: int
    length: int

    def sizes(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        if self.documents * 90 * int(n.max(initial=0)) >= 1 << 63:
            return np.array([10 + 90 * x * self.documents // self.length for x in n.tolist()], np.int64)
        return 10 + 90 * n * self.documents // self.length


@dataclass
class Lists:
    """The inverted lists of a block of documents: term t has impact[first[t] : first[t + 1]], falling, and the documents beside it."""

    ids: np.ndarray
    first: np.ndarray
    impact: np.ndarray
    doc: np.ndarray


def invert(ids: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, items: Items) -> Lists:
    tf = tf.astype(np.int64)
    impact = items.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * items.sizes(n)[doc]))
    some = np.flatnonzero(impact > 0)
    order = some[np.lexsort((-impact[some], term[some]))]
    return Lists(ids, np.searchsorted(term[order], np.arange(len(items.weight) + 1)), impact[order], doc[order])


def resolved(lists: Lists, terms: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(score, doc_id) of the best k of these lists' documents and of `best`, all of them final."""
    begin, size = lists.first[terms], lists.first[terms + 1] - lists.first[terms]
    begin, size = begin[size > 0], size[size > 0]
    if not len(size):
        return best
    depth = DEPTH
    while True:
        read = np.minimum(size, depth)
        end = np.cumsum(read)
        at = np.arange(end[-1]) + np.repeat(begin - end + read, read)
        # the impact at which each list stands bounds what it still holds; a list read to its end holds nothing
        stands = np.where(read < size, lists.impact[begin + read - 1], 0)
        met, own = np.unique(lists.doc[at], return_inverse=True)
        lower, passed = np.zeros(len(met), np.int64), np.zeros(len(met), np.int64)
        np.add.at(lower, own, lists.impact[at])
        np.add.at(passed, own, np.repeat(stands, read))
        unmet = int(stands.sum())
        upper = lower + (unmet - passed)
        known = np.concatenate([best[0], lower])
        bound = int(np.partition(known, len(known) - k)[len(known) - k]) if len(known) >= k else 0
        alive = np.flatnonzero(upper >= bound)
        if (unmet < bound or unmet == 0) and (lower[alive] == upper[alive]).all():
            score, ids = np.concatenate([best[0], lower[alive]]), np.concatenate([best[1], lists.ids[met[alive]]])
            order = np.lexsort((ids, -score))[:k]
            return score[order], ids[order]
        depth *= 2


def _ranked_rows(batches, items, k: int):
    """Each item's best k of the task's documents."""
    of: Items = items.value
    best = {}
    held, postings = [], 0

    def answer():
        ids, n, size = (np.concatenate([x[i] for x in held]) for i in range(3))
        lists = invert(ids, n, np.repeat(np.arange(len(ids)), size), np.concatenate([x[3] for x in held]), np.concatenate([x[4] for x in held]), of)
        for i in range(len(of.ids)):
            best[i] = resolved(lists, of.terms[of.first[i] : of.first[i + 1]], k, best.get(i, (np.zeros(0, np.int64), np.zeros(0, np.int64))))

    for batch in batches:
        terms, counts = batch.column("terms"), batch.column("counts")
        size = np.asarray(terms.value_lengths())
        held.append((np.asarray(batch.column("doc_id")), np.asarray(batch.column("n")), size, np.asarray(terms.flatten()), np.asarray(counts.flatten())))
        postings += int(size.sum())
        if postings >= POSTINGS:
            answer()
            held, postings = [], 0
    if held:
        answer()
    found = [(i, len(s)) for i, (s, _) in best.items() if len(s)]
    if found:
        which = np.repeat(np.array([i for i, _ in found]), np.array([n for _, n in found]))
        score, ids = (np.concatenate([best[i][x] for i, _ in found]) for x in (0, 1))
        yield pa.RecordBatch.from_arrays([of.ids.take(pa.array(which)), pa.array(ids), pa.array(score)], names=["item_id", "doc_id", "score"])


def _merged(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k)


def _of_block(docs: DataFrame, item_terms: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of a block of items; item_terms: distinct (item_id, term), a bounded number of rows."""
    spark = docs.sparkSession
    table = item_terms.orderBy("item_id").toArrow().combine_chunks()
    ids, terms = table.column("item_id").combine_chunks(), np.asarray(table.column("term")).view(np.uint64)
    vocabulary, place = np.unique(terms, return_inverse=True)
    runs = ids.dictionary_encode()
    first = np.searchsorted(np.asarray(runs.indices), np.arange(len(runs.dictionary) + 1))
    forward = docs.mapInArrow(partial(_forward_rows, vocabulary=spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, counts array<int>")
    forward = kept(forward, "forward")
    documents, length = forward.agg(F.count("n"), F.sum("n")).first()
    # no more rows than the block has terms
    counted = forward.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    weight = np.zeros(len(vocabulary), np.int64)
    weight[np.asarray(counted.column("term"))] = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in counted.column("count").to_pylist()]
    items = spark.sparkContext.broadcast(Items(runs.dictionary, first, place.reshape(-1), weight, documents, length or 1))
    schema = f"item_id {item_terms.schema['item_id'].dataType.simpleString()}, doc_id long, score long"
    lists = forward.where("doc_id is not null and size(terms) > 0").mapInArrow(partial(_ranked_rows, items=items, k=k), schema)
    lists = lists.withColumn("branch", F.spark_partition_id())
    for level in range(math.ceil(math.log(max(2, documents // BRANCH_ROWS), FAN_IN)) - 1, 0, -1):
        lists = _merged(lists.withColumn("branch", F.pmod("branch", F.lit(FAN_IN**level))), k, "item_id", "branch").drop("rank")
    return _merged(lists, k, "item_id").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, benchmark: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of the highest scores above 0, ties to smaller ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    terms = kept(asked.mapInArrow(_item_rows, asked.select("item_id").schema.add("term", "long")).distinct(), "item-terms")
    blocks = math.ceil(terms.count() / ITEM_TERMS)
    out = None
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        if not own.isEmpty():
            done = _of_block(docs, own, k)
            out = done if out is None else out.unionByName(done)
    return out if out is not None else terms.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))

"""Benchmark decontamination: which words of a document lie in a window of a benchmark item.

Texts are lower-cased (A-Z); words are runs of ASCII letters and digits and of all characters beyond ASCII.  A window is `width`
consecutive words of an item; an item of fewer words, but not none, is one window.  A document word is hit if it lies in any occurrence
of a window.

Method, a prefix-filtered set join.  Exact containment of a window needs all its shingles, so its one rarest shingle in the corpus is a
sufficient prefix.  A first pass counts the items' shingles in all documents; the second looks up prefixes in each document's shingles,
drops places where the window would not fit into the document (length and position), and compares the window word by word, rarest places first.
Windows are made and made distinct in Spark and dealt by hash to blocks of about `BLOCK_WORDS` words (and item names), so what reaches the driver and is
broadcast is bounded: a larger benchmark takes more passes, each of which adds its hits to those of the passes before.

Defined cases: null texts have no words; items without words or with a null item_id have no windows; repeated rows are judged each for
itself; repeated items count once; a text of any length is read
whole, long ones each for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.shared import kept
from tallyward.llm.textscan import ALNUM, Words, inner_starts, rolling, slices

WIDTH, SHINGLE = 10, 3
#: Window words in one broadcast block: 8 bytes each, besides the items' names.
BLOCK_WORDS = 4_000_000


class Windows:
    """Windows of items, by length: a matrix of word hashes, the place of each one's prefix shingle, and the items that hold it."""

    def __init__(self, words: np.ndarray, items: list[list[str]], size: int):
        self.words, self.items, self.size = words, items, size
        self.order: np.ndarray | None = None

    @property
    def shingles(self) -> np.ndarray:
        """A row of shingle hashes for each window."""
        n = self.words.shape[1]
        return np.stack([rolling(self.words[:, i : i + self.size].reshape(-1), self.size)[:: self.size] for i in range(n - self.size + 1)], axis=1)

    def arrange(self, known: np.ndarray, counts: np.ndarray) -> None:
        """Chooses prefixes by rarity and sorts the windows by them."""
        shingles = self.shingles
        at = np.searchsorted(known, shingles)
        rarity = np.where(known[np.minimum(at, len(known) - 1)] == shingles, counts[np.minimum(at, len(known) - 1)], 0) if len(known) else np.zeros(shingles.shape)
        self.place = rarity.argmin(axis=1)
        prefix = shingles[np.arange(len(shingles)), self.place]
        order = np.argsort(prefix, kind="stable")
        self.prefix, self.place, self.words = prefix[order], self.place[order], self.words[order]
        self.items = [self.items[i] for i in order]

    def occurrences(self, h: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of all occurrences in texts with these word hashes."""
        m = self.words.shape[1]
        s = rolling(h, self.size)
        low, high = np.searchsorted(self.prefix, s, "left"), np.searchsorted(self.prefix, s, "right")
        at = np.flatnonzero(high > low)
        n = high[at] - low[at]
        window = np.repeat(low[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        start = np.repeat(at, n) - self.place[window]
        fits = (start >= 0) & (start + m <= len(h))
        start, window = start[fits], window[fits]
        inside = (start >= first[text[start]]) & (start + m <= first[text[start] + 1])
        start, window = start[inside], window[inside]
        for j in range(m):
            same = h[start + j] == self.words[window, j]
            start, window = start[same], window[same]
        return start, window


def _window_rows(batches, width: int):
    """The windows of items, each as the hashes of its words."""
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs, ALNUM, lower=True)
            h, n = words.hashes(), words.counts
            start, text = inner_starts(words.first, width)
            short = np.flatnonzero((n > 0) & (n < width))
            start, text = np.concatenate([start, words.first[:-1][short]]), np.concatenate([text, short])
            size = np.minimum(n[text], width)
            end = np.cumsum(size)
            at = np.arange(size.sum()) - np.repeat(end - size, size) + np.repeat(start, size)
            lists = pa.ListArray.from_arrays(np.append(0, end).astype(np.int32), pa.array(h[at].view(np.int64)))
            yield pa.RecordBatch.from_arrays([lists, rows.column("item_id").take(pa.array(text))], names=["words", "item_id"])


def _blocks(benchmark: DataFrame, width: int) -> Iterator[list[Windows]]:
    """The windows with the items that hold them, dealt by hash to blocks of a bounded size, so that a window of very many items lies in several."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    rows = kept(items.mapInArrow(partial(_window_rows, width=width), "words array<long>, item_id string").distinct(), "windows")
    cost = rows.agg(F.sum(F.size("words") + F.ceil(F.octet_length("item_id") / 8))).first()[0] or 0
    n = math.ceil(cost / BLOCK_WORDS)
    for block in range(n):
        table = rows.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(n)) == block).toArrow()
        if table.num_rows:
            yield _by_length(table)


def _by_length(table: pa.Table) -> list[Windows]:
    lists = table.column("words").combine_chunks().cast(pa.list_(pa.int64()))
    size, flat, names = np.asarray(lists.value_lengths()), np.asarray(lists.flatten()).view(np.uint64), table.column("item_id").to_pylist()
    first = np.cumsum(size) - size
    out = []
    for m in np.unique(size).tolist():
        rows = np.flatnonzero(size == m)
        words, owner = np.unique(flat[first[rows][:, None] + np.arange(m)], axis=0, return_inverse=True)
        held: list[list[str]] = [[] for _ in words]
        for i, row in zip(owner.reshape(-1).tolist(), rows.tolist(), strict=True):
            held[i].append(names[row])
        out.append(Windows(words, [sorted(x) for x in held], min(SHINGLE, m)))
    return out


def _count_rows(batches, wanted):
    for batch in batches:
        for _, data, offs in slices(batch):
            h = Words(data, offs, ALNUM, lower=True).hashes()
            for size, known in wanted.value.items():
                s = rolling(h, size)
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                found, n = np.unique(s[known[at] == s], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([size] * len(found), pa.int32()), found.view(np.int64), n.astype(np.int64)], names=["size", "shingle", "n"])


def _hit_rows(batches, model):
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs, ALNUM, lower=True)
            h, text = words.hashes(), words.text_of()
            spans: list[list[int]] = [list(x or ()) for x in rows.column("spans").to_pylist()]
            items: list[set[str]] = [set(x or ()) for x in rows.column("items").to_pylist()]
            for w in model.value:
                for start, window in zip(*(x.tolist() for x in w.occurrences(h, words.first, text)), strict=True):
                    i = text[start]
                    spans[i] += [start - int(words.first[i]), start - int(words.first[i]) + w.words.shape[1]]
                    items[i].update(w.items[window])
            n_hit = [_covered(x) for x in spans]
            out = [rows.column("others"), rows.column("text"), words.counts.astype(np.int64), pa.array(n_hit, pa.int64())]
            out += [pa.array(spans, pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(out, names=["others", "text", "n_words", "n_hit", "spans", "items"])


def _covered(spans: list[int]) -> int:
    total, end = 0, 0
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, columns: list[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, spans, items): row is the struct of the document's columns (or some of them), spans the word ranges of occurrences, items sorted."""
    spark: SparkSession = docs.sparkSession
    # the text passes through Python once, apart from the others of the row
    columns = columns or docs.columns
    others = [docs[f"`{c}`"] for c in columns if c != "text"] or [F.lit(0).alias("none")]
    state = docs.select(F.struct(*others).alias("others"), "text")
    state = state.select("others", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = state.schema
    texts, done = docs.select("text"), False
    for block in _blocks(benchmark, width):
        wanted: dict[int, np.ndarray] = {}
        for w in block:
            wanted[w.size] = np.union1d(wanted.get(w.size, np.zeros(0, np.uint64)), w.shingles)
        sent = spark.sparkContext.broadcast(wanted)
        counts = texts.mapInArrow(partial(_count_rows, wanted=sent), "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
        found = counts.toPandas()  # no more rows than the block has shingles
        for w in block:
            own = found[found["size"] == w.size].sort_values("shingle")
            known = own["shingle"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(known)
            w.arrange(known[order], own["n"].to_numpy()[order])
        if done:
            state = kept(state, "hits")
        state = state.mapInArrow(partial(_hit_rows, model=spark.sparkContext.broadcast(block)), schema)
        done = True
    if not done:  # no windows: words are still counted
        state = state.mapInArrow(partial(_hit_rows, model=spark.sparkContext.broadcast([])), schema)
    row = F.struct(*[F.col("text") if c == "text" else F.col("others").getField(c).alias(c) for c in columns])
    return state.select(row.alias("row"), "n_words", "n_hit", "spans", "items")

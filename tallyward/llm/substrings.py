"""Removal of word sequences that occur earlier in the corpus, found by recompression.

A window is `width` consecutive words of one document.  A word is removed if a window covering it also starts earlier: in a smaller
doc_id, or at an earlier word of the same document.  Windows are judged on the input.

Method.  Every text is parsed by rounds of recompression: a round names runs of equal symbols, then pairs of a left-class and a
right-class symbol.  A name is a 64-bit hash of what it stands for, so that all tasks agree on names without a dictionary.  Each symbol
carries the interval of words on which its parse depends: if a window holds that interval, any other occurrence of the window holds the
same symbol.  One aggregation over the corpus finds the phrases of symbols that occur once; every window that holds such a phrase is
unique.  What is left is named by its interior symbols and the words around them: equal windows share them all.  An aggregation gives the
earliest start of each name, and all other starts are repeats.  Words are named by 64-bit hashes of their bytes; 31 bits of another hash
of the window's words, from their bytes with other keys, stand beside each name.  No group of equal windows is ever gathered: both
aggregations are combined before the shuffle.

Defined cases: null and empty texts have no words; documents shorter than a window are untouched; rows that share a doc_id share their
places, so that the same start in two such rows isn't earlier than itself.  A row with a null doc_id has no place in the order: it is
kept whole, and no other row loses words to it.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textscan import Words, combine, inner_starts, mix, rolling, slices

WIDTH = 20
ROUNDS = 2
_FAR = np.int64(1 << 40)


class Symbols:
    """A parse of some texts: names, the words [left, right) that each depends on, texts, and the first word of each."""

    def __init__(self, name, left, right, text, begin):
        self.name, self.left, self.right, self.text, self.begin = name, left, right, text, begin

    def neighbours(self):
        """The left limit of each symbol's left neighbour and the right limit of its right one; far off at a text's ends."""
        same = self.text[1:] == self.text[:-1]
        left, right = np.full(len(self.name), -_FAR), np.full(len(self.name), _FAR)
        left[1:][same], right[:-1][same] = self.left[:-1][same], self.right[1:][same]
        return left, right

    def runs(self) -> Symbols:
        """Names maximal runs of equal symbols; each depends on the neighbours that end it."""
        if not len(self.name):
            return self
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(self.name)))
        left, right = self.neighbours()
        name = np.where(length > 1, combine(self.name[at], length.astype(np.uint64)), self.name[at])
        return Symbols(name, left[at], right[at + length - 1], self.text[at], self.begin[at])

    def pairs(self, turn: int) -> Symbols:
        """Names pairs of a left-class and a right-class symbol; a symbol that stays alone depends on the neighbour it might have met."""
        if not len(self.name):
            return self
        is_right = (mix(self.name ^ np.uint64(turn * 7919 + 13)) >> np.uint64(7)) & np.uint64(1) == 1
        first, second = np.zeros(len(self.name), bool), np.zeros(len(self.name), bool)
        first[:-1] = ~is_right[:-1] & is_right[1:] & (self.text[1:] == self.text[:-1])
        second[1:] = first[:-1]
        before, after = self.neighbours()
        alone = ~first & ~second
        left = np.where(alone & is_right, before, self.left)
        right = np.where(alone & ~is_right, after, self.right)
        i, name = np.flatnonzero(first), self.name.copy()
        name[i], right[i] = combine(self.name[i], self.name[i + 1]), self.right[i + 1]
        keep = ~second
        return Symbols(name[keep], left[keep], right[keep], self.text[keep], self.begin[keep])

    def phrases(self) -> Symbols:
        """The symbols whose hash is least among their neighbours', named with both neighbours."""
        n = len(self.name)
        v, same = mix(self.name), self.text[1:] == self.text[:-1]
        least = np.ones(n, bool)
        least[1:] &= ~same | (v[1:] <= v[:-1])
        least[:-1] &= ~same | (v[:-1] < v[1:])
        before, after = self.neighbours()
        i = np.flatnonzero(least & (before > -_FAR // 2) & (after < _FAR // 2))
        name = combine(combine(self.name[i - 1], self.name[i]), self.name[np.minimum(i + 1, n - 1)])
        return Symbols(name, before[i], after[i], self.text[i], self.begin[i])


def symbols_of(hashes: np.ndarray, first: np.ndarray) -> Symbols:
    """The symbols after all rounds."""
    at = np.arange(len(hashes), dtype=np.int64)
    s = Symbols(hashes, at, at + 1, np.repeat(np.arange(len(first) - 1), np.diff(first)), at)
    for turn in range(ROUNDS):
        s = (s.runs() if turn == 0 else s).pairs(turn)
    return s


def parse(hashes: np.ndarray, first: np.ndarray, width: int) -> Symbols:
    """The phrases that tell windows apart: those whose words fit in a window."""
    return fitting(symbols_of(hashes, first), width)


def fitting(s: Symbols, width: int) -> Symbols:
    s = s.phrases()
    fits = s.right - s.left <= width
    return Symbols(*(x[fits] for x in (s.name, s.left, s.right, s.text, s.begin)))


def window_keys(h: np.ndarray, first: np.ndarray, s: Symbols, start: np.ndarray, width: int) -> np.ndarray:
    """A name of each window: a hash of its interior symbols in order, between the words before the first and after the last of them.

    A symbol is interior if the window holds all that it depends on, so equal windows have the same interior symbols at the same places; and
    symbols stand for words, so equal sequences stand for equal windows.
    """
    n = len(s.name)
    if not n or not len(start):
        return np.zeros(len(start), np.uint64)
    left, right = np.maximum(s.left, first[s.text] - 1), np.minimum(s.right, first[s.text + 1] + 1)
    end = np.append(s.begin[1:], first[-1])
    end = np.minimum(end, first[s.text + 1])
    low, high = np.searchsorted(left, start, "left"), np.searchsorted(right, start + width, "right")
    some = high > low
    low, high = np.where(some, low, 0), np.where(some, high, 0)
    before = np.where(some, s.begin[np.minimum(low, n - 1)] - start, width)
    inner = before + high - low
    after = np.where(some, end[np.maximum(high, 1) - 1], 0)  # the first word after the symbols
    total = inner + np.where(some, start + width - after, 0)
    out = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(int(total.max())):
            word = np.where(t < before, start + t, after + t - inner)
            symbol = (t >= before) & (t < inner)
            x = np.where(symbol, s.name[np.clip(low + t - before, 0, n - 1)], h[np.clip(word, 0, len(h) - 1)])
            out = np.where(t < total, out * np.uint64(0x9E3779B97F4A7C15) + x, out)
        return mix(out + total.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _ids(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = rows.column("doc_id")
    return np.asarray(column.is_valid()), np.asarray(column.fill_null(0))


def _phrase_rows(batches, width: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs)
            s = parse(words.hashes(), words.first, width)
            known, ids = _ids(rows)
            s = Symbols(*(x[known[s.text]] for x in (s.name, s.left, s.right, s.text, s.begin)))
            name, at, n = np.unique(s.name, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(name), n.astype(np.int64), ids[s.text[at]], np.asarray(s.left[at] - words.first[s.text[at]], np.int32)],
                names=["name", "n", "doc_id", "at"],
            )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row of each."""
    lists = column.cast(pa.list_(pa.int32()))
    return np.asarray(lists.flatten()), np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))


def _open_windows(words: Words, rows: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows that hold no phrase that occurs once: first word, text, name, and a hash of the words."""
    h, second = words.both_hashes()
    symbols = symbols_of(h, words.first)
    s = fitting(symbols, width)
    once, row = _lists(rows.column("once"))
    alone = np.isin((s.text << 32) + (s.left - words.first[s.text]), (row.astype(np.int64) << 32) + once)
    change = np.zeros(len(h) + 2, np.int32)
    np.add.at(change, np.maximum(s.right[alone] - width, words.first[s.text[alone]]), 1)
    np.add.at(change, s.left[alone] + 1, -1)
    unique = np.cumsum(change)
    start, text = inner_starts(words.first, width)
    left = (unique[start] == 0) & _ids(rows)[0][text]
    start, text = start[left], text[left]
    return start, text, window_keys(h, words.first, symbols, start, width), rolling(second, width, second=True)[start]


def _window_rows(batches, width: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs)
            start, text, one, two = _open_windows(words, rows, width)
            ids = _ids(rows)[1]
            yield pa.RecordBatch.from_arrays(
                [_signed(one), (two >> np.uint64(33)).astype(np.int32), ids[text], np.asarray(start - words.first[text], np.int32)],
                names=["one", "two", "doc_id", "at"],
            )


def _kept_rows(batches, width: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            words = Words(data, offs)
            start, text, _, _ = _open_windows(words, rows, width)
            firsts, row = _lists(rows.column("firsts"))
            later = ~np.isin((text << 32) + (start - words.first[text]), (row.astype(np.int64) << 32) + firsts)
            change = np.zeros(len(words) + width + 1, np.int32)
            np.add.at(change, start[later], 1)
            np.add.at(change, start[later] + width, -1)
            gone = np.cumsum(change)[: len(words)] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), join_words(words, ~gone), words.counts.astype(np.int64), removed[words.first[1:]] - removed[words.first[:-1]]],
                names=["doc_id", "text", "n_words", "n_removed"],
            )


def join_words(words: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words with one blank between them."""
    i = np.flatnonzero(keep)
    text = words.text_of()[i]
    size = words.end[i] - words.start[i]
    size[:-1] += text[1:] == text[:-1]
    out = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(out[-1]) + np.repeat(words.start[i] - out[:-1], size)
    data = np.append(words.data, np.uint8(32))[at]
    blank = out[1:][np.flatnonzero(size > words.end[i] - words.start[i])] - 1
    data[blank] = 32
    first = np.searchsorted(text, np.arange(len(words.offs)))
    return pa.StringArray.from_buffers(len(words.offs) - 1, pa.py_buffer(out[first].astype(np.int32)), pa.py_buffer(data))


def _places(docs: DataFrame) -> tuple[Column, Column, Column]:
    """Columns that make one comparable value of (doc_id, at) and take it apart: a long where ids and lengths leave room, else a struct."""
    low, high, longest = docs.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("text"))).first()
    low, high, bits = min(low or 0, 0), max(high or 0, 0), int(longest or 1).bit_length()
    if (high - low).bit_length() + bits < 63:
        made = (F.col("doc_id") - F.lit(low)) * F.lit(1 << bits) + F.col("at")
        return made, F.shiftright("place", bits) + F.lit(low), F.col("place").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    made = F.struct("doc_id", "at")
    return made, F.col("place.doc_id"), F.col("place.at")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, n_words, n_removed): text holds the kept words with one blank between them."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place, doc_id, at = _places(texts)
    phrases = texts.mapInArrow(partial(_phrase_rows, width=width), "name long, n long, doc_id long, at int")
    once = (
        phrases.withColumn("place", place).groupBy("name").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
        .where("n = 1").select(doc_id.alias("doc_id"), at.alias("at")).groupBy("doc_id").agg(F.collect_list("at").alias("once"))
    )
    marked = texts.join(once.hint("shuffle_hash"), "doc_id", "left")
    windows = marked.mapInArrow(partial(_window_rows, width=width), "one long, two int, doc_id long, at int")
    firsts = (
        windows.withColumn("place", place).groupBy("one", "two").agg(F.min("place").alias("place"))
        .select(doc_id.alias("doc_id"), at.alias("at")).groupBy("doc_id").agg(F.collect_list("at").alias("firsts"))
    )
    return marked.join(firsts.hint("shuffle_hash"), "doc_id", "left").mapInArrow(
        partial(_kept_rows, width=width), "doc_id long, text string, n_words long, n_removed long"
    )

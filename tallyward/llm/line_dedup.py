"""Removal of lines that repeat earlier lines, by windows of three consecutive lines.

Lines end at line feeds; a text with n line feeds has n + 1 lines.  Windows are compared by two
64-bit hashes of their lines' bytes (128 bits).  A window is `width` consecutive lines of one
document.  The first occurrence of a window, by doc_id and line number, stays; every line that a later occurrence covers goes.
Windows are judged on the input.  An aggregation gives each window's first place; a document's other windows are later ones.

Defined cases: a document of fewer lines than a window has none and stays whole (so do null and empty texts, and rows with a null
doc_id); rows that share a doc_id share their places; removing all lines leaves an empty text.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textscan import inner_starts, rolling, slices, span_hashes

WIDTH = 3


class Lines:
    """The lines of some texts, with the index of each text's first line."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = data
        feeds = np.flatnonzero(data == 10)
        self.start = np.sort(np.concatenate([offs[:-1], feeds + 1]))
        self.end = np.sort(np.concatenate([feeds, offs[1:]]))
        feeds_before = np.searchsorted(feeds, offs)
        self.first = feeds_before + np.arange(len(offs))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _windows(lines: Lines, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    start, text = inner_starts(lines.first, width)
    one, two = span_hashes(lines.data, lines.start, lines.end, second=True)
    return start, text, rolling(one, width)[start], rolling(two, width, second=True)[start]


def _window_rows(batches, width: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            lines = Lines(data, offs)
            start, text, one, two = _windows(lines, width)
            ids = np.asarray(rows.column("doc_id"))
            at = (start - lines.first[text]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([one.view(np.int64), two.view(np.int64), ids[text], at], names=["one", "two", "doc_id", "at"])


def _kept_rows(batches, width: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            lines = Lines(data, offs)
            start, text = inner_starts(lines.first, width)
            firsts = rows.column("firsts").cast(pa.list_(pa.int32()))
            row = np.repeat(np.arange(len(firsts), dtype=np.int64), np.asarray(firsts.value_lengths().fill_null(0)))
            known = np.asarray(rows.column("doc_id").is_valid())
            later = known[text] & ~np.isin((text << 32) + (start - lines.first[text]), (row << 32) + np.asarray(firsts.flatten()))
            change = np.zeros(len(lines.start) + width + 1, np.int32)
            np.add.at(change, start[later], 1)
            np.add.at(change, start[later] + width, -1)
            gone = np.cumsum(change)[: len(lines.start)] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])
            removed = removed[lines.first[1:]] - removed[lines.first[:-1]]
            texts = rows.column("text").to_pylist()
            for i in np.flatnonzero(removed):
                a, b = lines.first[i], lines.first[i + 1]
                kept = a + np.flatnonzero(~gone[a:b])
                texts[i] = b"\n".join(data[s:e].tobytes() for s, e in zip(lines.start[kept], lines.end[kept], strict=True)).decode()
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("doc_id"), pa.array(texts, pa.string()), lines.counts.astype(np.int64), removed],
                names=["row", "doc_id", "text", "n_lines", "n_removed"],
            )


def remove_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row, doc_id, text, n_lines, n_removed): row is the struct of the document's other columns, text what is left."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(*[docs[f"`{c}`"] for c in others]) if others else F.struct(F.lit(None).cast("int").alias("none"))
    texts = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = known.mapInArrow(partial(_window_rows, width=width), "one long, two long, doc_id long, at int")
    firsts = windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "at")).alias("place"))
    firsts = firsts.groupBy(F.col("place.doc_id").alias("doc_id")).agg(F.collect_list("place.at").alias("firsts"))
    joined = texts.join(firsts.hint("shuffle_hash"), "doc_id", "left").select("row", "doc_id", "text", "firsts")
    schema = joined.select("row", "doc_id", "text").schema.add("n_lines", "long").add("n_removed", "long")
    return joined.mapInArrow(partial(_kept_rows, width=width), schema)

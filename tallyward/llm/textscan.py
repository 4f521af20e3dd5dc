"""Vectorised word scanning of Arrow text columns.

Texts stay in Arrow's UTF-8 buffers: words are found and hashed with numpy over whole slices of a batch, so no Python string is made
per word.  All separators used here are ASCII, hence a byte-wise scan splits UTF-8 text exactly as the regular expressions do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 21

#: Bases and keys of the hashes: odd 64-bit numbers.
_P = 0x9E3779B97F4A7C15 | 5
_P_2 = 0xC2B2AE3D27D4EB4F
_KEYS = (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)


def _lut(is_separator) -> np.ndarray:
    return np.array([not is_separator(b) for b in range(256)])


#: True for bytes inside words.
NOT_BLANK = _lut(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
ALNUM = _lut(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
NOT_NEWLINE = _lut(lambda b: b == 0x0A)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) + np.uint64(1))


def as_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts a batch into runs of rows of about `limit` bytes of text: (rows, bytes, offsets)."""
    data, offs = as_text(batch.column(column))
    n, at = batch.num_rows, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


class Words:
    """The words of some texts: byte spans, and the index of each text's first word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, inside: np.ndarray = NOT_BLANK, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offs = offs
        word = inside[self.data]
        start, end = word.copy(), word.copy()
        if len(data):
            start[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            full = offs[1:] > offs[:-1]
            first, last = offs[:-1][full], offs[1:][full] - 1
            start[first], end[last] = word[first], word[last]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offs)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The index of the text that each word is in."""
        return np.repeat(np.arange(len(self.offs) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)[0]

    def both_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each word, both from its bytes."""
        return span_hashes(self.data, self.start, self.end, second=True)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> tuple[np.ndarray, ...]:
    """A 64-bit hash of each span of bytes; `second`: and another one of the same bytes with keys of its own.

    A span is cut into blocks of eight bytes from its start; each block is mixed with a key of its place, and the blocks are summed.
    """
    size = end - start
    blocks = (size + 7) >> 3
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))  # the eight bytes from each byte on
    block = eights[np.repeat(start, blocks) + (place << 3)].astype(np.uint64)
    beyond = np.maximum(8 - (np.repeat(size, blocks) - (place << 3)), 0).astype(np.uint64) << np.uint64(3)
    block = (block << beyond) >> beyond
    place = place.astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for key in _KEYS[: 1 + second]:
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(mix(block * np.uint64(key | 1) ^ mix((place + np.uint64(1)) * np.uint64(key))), out=total[1:])
            out.append(mix(total[first + blocks] - total[first] + size.astype(np.uint64) * np.uint64(key)))
    return tuple(out)


def rolling(h: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """A hash of each run of k neighbours, by its first index (len(h) - k + 1 of them); `second`: with another base."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        base = _P_2 if second else _P
        out = np.zeros(n, np.uint64)
        for i in range(k):  # Horner's rule over k shifted views
            out = out * np.uint64(base) + h[i : i + n]
        return mix(out)


def inner_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start indices of the runs of k items that stay in one text, and each run's text; first: the texts' first items and the end."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return first[:-1][text] + (np.arange(len(text)) - begin[text]), text

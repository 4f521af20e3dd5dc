"""Byte-level BPE encoding and decoding of whole texts, with tree concatenation of long ones.

A text of up to `LONG` characters is encoded where it lies.  A longer one is halved again and again; its pieces are spread over the
cluster, encoded in parallel, and joined in the order of the halves.  A cut is put before a blank that follows a character that isn't
white: no match of the splitting pattern spans such a place, so both sides stand as they are.  Text without such a place is cut
anywhere and joined by re-encoding: the window of tokens around the join grows until its encoding starts with the left side's token
and ends with the right side's.  Then every pair of neighbouring tokens is one that the merges leave alone, and the whole is exact.

Pieces of Latin characters (below U+0250) go to the faster of two encoders of the same vocabulary, other pieces to the tokenizers
library; both give the same ids, as tests show character by character.  Null texts are empty; strings of special tokens in a text become those tokens.
Repeated rows and rows of one doc_id, or of none, are encoded each for itself; an empty table gives an empty one.
The vocabulary's path is a parameter.
"""

from __future__ import annotations

import functools
import json
import os
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 1 << 15
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85\xa0]) ")
_OTHER = re.compile("[^\x00-ɏ]")
#: Fixed value: the splitting pattern of the byte-level vocabulary.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """One vocabulary file, loaded once in each worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.bytes_of: list[bytes] = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()

    def encode(self, text: str) -> list[int]:
        if _OTHER.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all", disallowed_special=())

    def decode(self, ids: list[int]) -> str:
        return self.bytes(ids).decode("utf-8", "replace")

    def bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


vocabulary = functools.lru_cache(4)(Vocabulary)


def _middle(text: str, special: list[str]) -> tuple[int, bool]:
    """Where to halve a text, and if both sides stand as they are there."""
    half = len(text) // 2
    found = _CUT.search(text, half, half + len(text) // 4)
    if found:
        return found.start(), True
    for s in special:
        at = text.find(s, max(0, half - len(s) + 1), half + len(s) - 1)
        if 0 <= at < half:
            half = at or len(s)
    return half, False


def halves(text: str, special: list[str], size: int) -> list[tuple[str, str]]:
    """Pieces of at most `size` characters (unless uncuttable), each with the path of halvings that led to it, where 'x' marks a free cut.

    A path is a row of L and R steps; upper case steps are at cuts where both sides stand as they are, lower case ones need a join.
    """
    if len(text) <= size:
        return [("", text)]
    at, clean = _middle(text, special)
    if not 0 < at < len(text):
        return [("", text)]
    left, right = ("L", "R") if clean else ("l", "r")
    return [(left + p, t) for p, t in halves(text[:at], special, size)] + [(right + p, t) for p, t in halves(text[at:], special, size)]


def _may_start(raw: bytes, at: int) -> bool:
    """If a scan that starts here splits what follows as a scan of the whole does: at a character, and not in or at a contraction."""
    return raw[at] & 0xC0 != 0x80 and b"'" not in raw[max(0, at - 3) : at + 1]


def join(left: list[int], right: list[int], v: Vocabulary) -> list[int]:
    """The encoding of two neighbouring texts' concatenation, from their encodings."""
    if not left or not right:
        return left + right
    width = 8
    while width < len(left) or width < len(right):
        a, b = left[-width:], right[:width]
        raw = v.bytes(a) + v.bytes(b)
        whole_left, whole_right = width >= len(left), width >= len(right)
        after = v.bytes(right[width : width + 2])
        edges = (whole_left or (_may_start(raw, 0) and b"'" not in v.bytes(left[-width - 4 : -width])[-3:] and not raw[:1].isspace())) and (
            whole_right or (_may_start(after, 0) and not raw[-1:].isspace() and not after[:1].isspace() and b"'" not in raw[-3:] and b"'" not in after[:3])
        )
        if edges:
            made = v.encode(raw.decode("utf-8", "replace"))
            if (whole_left or made[:1] == a[:1]) and (whole_right or made[-1:] == b[-1:]):
                return left[:-width] + made + right[width:] if not whole_left else made + right[width:]
        width *= 2
    return v.encode((v.bytes(left) + v.bytes(right)).decode("utf-8", "replace"))


def concatenated(pieces: list[tuple[str, list[int]]], v: Vocabulary) -> list[int]:
    """Joins the pieces (path, ids), all of one text, up the tree of halves."""
    if len(pieces) == 1:
        return pieces[0][1]
    left = [(p[1:], ids) for p, ids in pieces if p[0] in "Ll"]
    right = [(p[1:], ids) for p, ids in pieces if p[0] in "Rr"]
    one, two = concatenated(left, v), concatenated(right, v)
    return one + two if pieces[0][0][0].isupper() else join(one, two, v)


def _ids_column(rows: list[list[int]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encoded_rows(batches, path: str, step: int = 256):
    v = vocabulary(path)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            ids = [v.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _ids_column(ids), pa.array([v.decode(r) for r in ids])], names=["doc_id", "ids", "text"])


def _piece_rows(batches, path: str, size: int):
    special = list(vocabulary(path).special)
    for batch in batches:
        for i, digest, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "text")), strict=True):
            pieces = halves(text, special, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(pieces), pa.int64()), pa.array([digest] * len(pieces)), pa.array([p for p, _ in pieces]), pa.array([t for _, t in pieces])],
                names=["doc_id", "digest", "path", "text"],
            )


def _encoded_pieces(batches, path: str):
    v = vocabulary(path)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            ids = [v.encode(row.column("text")[0].as_py())]
            yield pa.RecordBatch.from_arrays([row.column("doc_id"), row.column("digest"), row.column("path"), _ids_column(ids)], names=["doc_id", "digest", "path", "ids"])


def _joined(group: pa.Table, path: str) -> pa.Table:
    v = vocabulary(path)
    pieces: dict[str, list[int]] = {}
    copies: dict[str, int] = {}
    for p, ids in zip(group.column("path").to_pylist(), group.column("ids").to_pylist(), strict=True):
        pieces[p] = ids
        copies[p] = copies.get(p, 0) + 1
    ids, n = concatenated(list(pieces.items()), v), max(copies.values())
    doc = group.column("doc_id")[0].as_py()
    return pa.Table.from_arrays([pa.array([doc] * n, pa.int64()), _ids_column([ids] * n), pa.array([v.decode(ids)] * n)], names=["doc_id", "ids", "text"])


def encode(docs: DataFrame, path: str, long: int = LONG) -> DataFrame:
    """(doc_id, ids, text): each text's ids as the tokenizers library gives them without added special tokens, and what they decode to."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.octet_length("text") > long
    schema = "doc_id long, ids array<int>, text string"
    short = texts.where(~is_long).mapInArrow(partial(_encoded_rows, path=path), schema)
    pieces = texts.where(is_long).withColumn("digest", F.xxhash64("text")).mapInArrow(partial(_piece_rows, path=path, size=long), "doc_id long, digest long, path string, text string")
    spread = pieces.repartition("doc_id", "digest", "path")
    parts = spread.mapInArrow(partial(_encoded_pieces, path=path), "doc_id long, digest long, path string, ids array<int>")
    return short.unionByName(parts.groupBy("doc_id", "digest").applyInArrow(lambda group: _joined(group, path), schema))


def _decoded_rows(batches, path: str):
    v = vocabulary(path)
    for batch in batches:
        text = pa.array([v.decode(r or []) for r in batch.column("ids").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], names=["doc_id", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ids; special tokens are kept, null ids are none, bytes that aren't UTF-8 become U+FFFD."""
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decoded_rows, path=path), "doc_id long, text string")

"""Removal of byte strings that occur earlier in the corpus, by sorting suffixes bucket by bucket with a difference cover.

A window is `width` consecutive bytes (UTF-8) of one document: the first bytes of a suffix.  A byte is removed if a window over it also starts earlier, in a
smaller doc_id or at an earlier byte of the same document.  Windows are judged on the input.

The sample.  The positions p of a document with p mod v in a difference cover D are its cover samples: for any two positions i and j there is a k < v such that i + k and
j + k are both samples.  So two equal windows hold, at the same distance, two samples that are followed by the same width - v + 1 bytes, their stem.

1. The corpus is put in the order of doc_id and cut into chunks of whole documents, kept as a table bucketed by parts, so that later joins bring small tables to it and never move a text again.
2. The samples' stems are sorted, bucket by bucket; samples with a stem of their own are done with, and so are suffixes without other samples.
3. Ranks of the other samples: what lies around a sample, from v - 1 bytes before it to width bytes after it, holds all windows through it.  These neighbourhoods are
   sorted under their stems, bucket by bucket.  A sample whose neighbourhood has an earlier equal settles all its windows at once, which resolves long ties (copies, and passages longer than a
   window) by sample ranks alone.  A stem with one neighbourhood in all the corpus has nothing more to tell.
4. Only suffixes through samples whose stem has several neighbourhoods, the edges of repeats, are left.  They are sorted bucket by bucket; of equal ones all but the earliest are repeats.

A bucket is a range of names, not of first letters: names are 64-bit hashes of the bytes, which makes buckets equal where letters don't, and only equality and place matter here.
Names are polynomials over hashes of eight bytes each; 32 bits of a second polynomial stand beside the names of step 4, and the whole stem's beside a neighbourhood's.  The number of buckets grows with the corpus, so the memory
of sorting one doesn't.  A chunk sends a bucket its distinct names only, sorted and written as differences, and gets one bit back for each; as chunks follow the order of places, it needs to send no places.
So a string that is everywhere costs each chunk one name.  A chunk holds whole documents: memory grows with the longest one (some 60 bytes for each of its bytes).

Defined cases: null and empty texts have no bytes; a text shorter than a window keeps all.  Rows that share a doc_id are ordered by a hash of their text, so of
equal rows one stays and the others lose all that windows cover.  A row with a null doc_id has no place in the order: it is kept whole and no other row loses bytes to it.
What is left may end within a character, so it is binary.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import kept, shared_folder
from tallyward.llm.textscan import as_text, mix

WIDTH = 100
# Perfect difference sets (every distance modulo v occurs once).
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52), 73: (0, 1, 3, 7, 15, 31, 36, 54, 63)}
#: Bytes of a chunk and of a part (some chunks), and names that a bucket sorts, about.
CHUNK_BYTES, PART_BYTES, BUCKET_NAMES = 1 << 20, 1 << 23, 1 << 21
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SENT = "bucket int, part int, chunk long, names binary, beside binary"
_BITS = "part int, chunk long, bucket int, bits binary"


@dataclass(frozen=True)
class Plan:
    """What all tasks agree on: the cover, the bits of a stem's name in step 2 (enough to make false repeats rare), and the number of buckets (a power of two)."""

    width: int
    modulus: int
    bits: int
    split: int

    @property
    def stem(self) -> int:
        return self.width - self.modulus + 1


def plan(width: int, total: int) -> Plan:
    modulus = max((v for v in COVERS if v <= 3 * width // 4 and width - v + 1 >= 8), default=None)
    if modulus is None:
        raise ValueError("a window has 16 bytes at least")
    sampled = total * len(COVERS[modulus]) // modulus
    return Plan(width, modulus, min(64, total.bit_length() + 12), max(3, math.ceil(math.log2(max(1, sampled / BUCKET_NAMES)))))


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Chunk:
    """Texts one after another, in the order of their places; first: where each begins, and the end."""

    def __init__(self, data: np.ndarray, first: np.ndarray, of: Plan):
        self.of, self.data, self.first = of, data, first
        sizes = np.diff(first)
        self.begin, self.end = np.repeat(first[:-1], sizes), np.repeat(first[1:], sizes)
        self._letters: np.ndarray | None = None
        self._sums: dict[int, np.ndarray] = {}

    def names(self, start: np.ndarray, end: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
        """A hash of each span of eight bytes or more."""
        n = len(self.data)
        powers, inverses = _powers(1 << max(10, n.bit_length()), base)
        if base not in self._sums:
            if self._letters is None:
                padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
                self._letters = mix(np.ndarray((n,), "<u8", padded.data, strides=(1,)).astype(np.uint64))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self._letters * powers[:n], out=sums[1:])
            self._sums[base] = sums
        sums = self._sums[base]
        return mix((sums[end - 7] - sums[start]) * inverses[start] + (end - start).astype(np.uint64) * np.uint64(_BASES[1]))

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """The samples with a whole stem, and their stems' names."""
        v, cover = self.of.modulus, np.array(COVERS[self.of.modulus])
        begin, end = self.first[:-1], self.first[1:]
        periods = (end - begin + v - 1) // v
        before = np.cumsum(periods) - periods
        start = np.repeat(begin - before * v, periods) + np.arange(int(periods.sum())) * v
        at = (start[:, None] + cover).reshape(-1)
        at = at[at + self.of.stem <= np.repeat(end, periods * len(cover))]
        return at, self.names(at, at + self.of.stem)

    def neighbourhoods(self, at: np.ndarray) -> np.ndarray:
        start, end = np.maximum(self.begin[at], at - self.of.modulus + 1), np.minimum(self.end[at], at + self.of.width)
        return mix(self.names(start, end) + (at - start).astype(np.uint64) * np.uint64(_BASES[0]))

    def through(self, at: np.ndarray) -> np.ndarray:
        """True for the windows' starts from which these samples are less than v bytes away."""
        low, high = np.maximum(self.begin[at], at - self.of.modulus + 1), np.minimum(at, self.end[at] - self.of.width)
        some = high >= low
        return _covered(low[some], high[some] + 1, len(self.data))


def _covered(low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    change = np.bincount(low, minlength=size + 1) - np.bincount(high, minlength=size + 1)
    return np.cumsum(change)[:size] > 0


class Distinct:
    """The distinct rows of one or two columns, sorted; of: each row's place among them; later: rows that repeat an earlier one (of two columns)."""

    def __init__(self, names: np.ndarray, beside: np.ndarray | None = None):
        order = np.argsort(names) if beside is None else np.lexsort((beside, names))
        a, b = names[order], None if beside is None else beside[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) if b is None else (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.names, self.beside = a[new], None if b is None else b[new]
        self.of, self.later = np.empty(len(a), np.int64), np.empty(len(a), bool)
        self.of[order], self.later[order] = np.cumsum(new) - 1, ~new
        self.count = np.diff(np.append(np.flatnonzero(new), len(a)))

    def buckets(self, shift: int) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of the names with the same leading bits."""
        bucket = (self.names >> np.uint64(shift)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        return list(zip(bucket[cut].tolist(), cut.tolist(), np.append(cut, len(bucket))[1:].tolist(), strict=True))

    def sent(self, shift: int) -> list[tuple[int, bytes, bytes]]:
        return [(k, packed(self.names[a:b]), b"" if self.beside is None else self.beside[a:b].tobytes()) for k, a, b in self.buckets(shift)]

    def answered(self, shift: int, bits: dict[int, bytes], rows: int = 1) -> np.ndarray:
        """What the buckets say of each distinct row: `rows` bits, one below another."""
        out = np.zeros((rows, len(self.names)), bool)
        for k, a, b in self.buckets(shift):
            out[:, a:b] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=rows * (b - a)).reshape(rows, b - a)
        return out


def packed(names: np.ndarray) -> bytes:
    """Sorted names as differences, all first bytes, then all second bytes and so on, so that what is zero compresses."""
    return np.diff(names, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


# the buckets


def _bucket(table: pa.Table, kind=None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """(names, beside, chunk, first row of each chunk's share) of all that was sent to a bucket."""
    names = [unpacked(x.as_buffer()) for x in table.column("names")]
    chunks, size = np.asarray(table.column("chunk")), np.array([len(x) for x in names])
    beside = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column("beside")]) if kind else None
    return np.concatenate(names), beside, np.repeat(chunks, size), np.concatenate([[0], np.cumsum(size)])


def _answer(table: pa.Table, first: np.ndarray, *rows: np.ndarray) -> pa.Table:
    bits = [np.packbits(np.concatenate([r[a:b] for r in rows])).tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return pa.table({"part": table.column("part"), "chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _several(table: pa.Table) -> pa.Table:
    """Step 2: names that several chunks have."""
    names, _, _, first = _bucket(table)
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    hit = np.zeros(len(names), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    return _answer(table, first, hit)


def _earlier(table: pa.Table, kind: str, contested: bool) -> pa.Table:
    """Steps 3 and 4: rows that an earlier chunk has; contested: and names with different values beside them."""
    names, beside, chunk, first = _bucket(table, kind)
    order = np.lexsort((chunk, beside, names))
    same_name = names[order[1:]] == names[order[:-1]]
    same = same_name & (beside[order[1:]] == beside[order[:-1]])
    hit = np.zeros(len(names), bool)
    hit[order[1:][same]] = True
    if not contested:
        return _answer(table, first, hit)
    group = np.concatenate([[0], np.cumsum(~same_name)])
    mixed = np.zeros(len(names), bool)
    mixed[order] = np.isin(group, group[1:][same_name & ~same])
    return _answer(table, first, hit, mixed)


# the chunks


def _chunk_rows(batches):
    """Packs rows that come in order: (part, chunk, ids, sizes, data)."""
    ids: list[pa.Array] = []
    texts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    held, number, part = 0, 0, 0

    def packed_rows():
        row = pa.concat_arrays(ids)
        whole = np.concatenate(sizes)
        lists = [pa.ListArray.from_arrays(np.array([0, len(row)], np.int32), x) for x in (row, pa.array(whole))]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(part << 32) + number]), *lists, pa.array([np.concatenate(texts).tobytes()], pa.binary())], names=["part", "chunk", "ids", "sizes", "data"])

    for batch in batches:
        data, offs = as_text(batch.column("text"))
        part = batch.column("part")[0].as_py() if batch.num_rows else part
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + CHUNK_BYTES - held, "right")) - 1)
            ids.append(batch.column("doc_id").slice(at, end - at))
            texts.append(data[offs[at] : offs[end]])
            sizes.append(np.diff(offs[at : end + 1]))
            held += int(offs[end] - offs[at])
            at = end
            if held >= CHUNK_BYTES or at < batch.num_rows:
                yield packed_rows()
                ids, texts, sizes, held, number = [], [], [], 0, number + 1
    if ids:
        yield packed_rows()


class Judged:
    """What a chunk knows after the steps whose bits it is given; bits: for each step, bucket -> bytes."""

    def __init__(self, row: dict, of: Plan, bits: list[dict[int, bytes]]):
        sizes = np.array(row["sizes"], np.int64)
        self.chunk = c = Chunk(np.frombuffer(row["data"], np.uint8), np.concatenate([[0], np.cumsum(sizes)]), of)
        self.to_send, self.shift, self.gone = None, 64 - of.split, None
        with np.errstate(over="ignore"):
            at, stems = c.samples()
            sampled = Distinct(stems >> np.uint64(64 - of.bits))
            if not bits:
                self.to_send, self.shift = sampled, of.bits - of.split
                return
            several = sampled.answered(of.bits - of.split, bits[0])[0] | (sampled.count > 1)
            some = several[sampled.of]
            at, stems = at[some], stems[some]
            around = Distinct(stems, c.neighbourhoods(at))
            if len(bits) < 2:
                self.to_send = around
                return
            earlier, contested = around.answered(self.shift, bits[1], 2)
            settled = c.through(at[earlier[around.of] | around.later])
            left = np.flatnonzero(c.through(at[contested[around.of]]) & ~settled)
            windows = Distinct(c.names(left, left + of.width), (c.names(left, left + of.width, _BASES[1]) >> np.uint64(32)).astype(np.uint32))
            if len(bits) < 3:
                self.to_send = windows
                return
            repeats = left[windows.answered(self.shift, bits[2])[0][windows.of] | windows.later]
            starts = np.concatenate([np.flatnonzero(settled), repeats])
            self.gone = _covered(starts, starts + of.width, len(c.data))


def _judged(batches, of: Plan, steps: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("part", "chunk", "sizes", "data")}
            bits: list[dict[int, bytes]] = [{} for _ in range(steps)]
            for step in range(steps):
                for x in batch.column(f"bits_{step}")[i].as_py() or ():
                    if x["chunk"] == row["chunk"]:
                        bits[step][x["bucket"]] = x["bits"]
            yield row, batch.column("ids")[i].values, Judged(row, of, bits)


def _sent_rows(batches, of: Plan, steps: int):
    for row, _, judged in _judged(batches, of, steps):
        sent = judged.to_send.sent(judged.shift)
        if sent:
            bucket, names, beside = zip(*sent, strict=True)
            columns = [pa.array(bucket, pa.int32()), pa.array([row["part"]] * len(sent), pa.int32()), pa.array([row["chunk"]] * len(sent)), pa.array(names, pa.binary()), pa.array(beside, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "part", "chunk", "names", "beside"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _kept_rows(batches, of: Plan):
    for _, ids, judged in _judged(batches, of, 3):
        c, gone = judged.chunk, judged.gone
        removed = np.concatenate([[0], np.cumsum(gone)])
        edge = np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8))
        begins, ends = edge[:-1] == 1, edge[1:] == -1  # of runs, at their first and last bytes
        if len(gone):
            begins[c.first[:-1][c.first[:-1] < len(gone)]] |= gone[c.first[:-1][c.first[:-1] < len(gone)]]
            ends[c.first[1:][c.first[1:] > 0] - 1] |= gone[c.first[1:][c.first[1:] > 0] - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        runs = np.searchsorted(start, c.first).astype(np.int32)
        base = c.begin[start] if len(start) else start
        spans = pa.ListArray.from_arrays(runs, pa.StructArray.from_arrays([pa.array(start - base), pa.array(end - base)], names=["start", "end"]))
        left = c.data[~gone]
        size = np.diff(c.first) - np.diff(removed[c.first])
        kept_bytes = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(left.tobytes())])
        columns = [ids, pa.array(np.diff(c.first)), pa.array(np.diff(removed[c.first])), spans, kept_bytes.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


_OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _chunks(texts: DataFrame, total: int) -> tuple[DataFrame, int]:
    """The corpus by doc_id, packed and written as a table bucketed by part."""
    spark = texts.sparkSession
    parts = max(1, math.ceil(total / PART_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / CHUNK_BYTES)))
    ordered = texts.withColumn("_order", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "_order").sortWithinPartitions("doc_id", "_order")
    rows = ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_chunk_rows, "part int, chunk long, ids array<long>, sizes array<long>, data binary")
    name = f"chunks_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}").bucketBy(parts, "part").saveAsTable(name)
    return spark.table(name), parts


def remove_repeated_bytes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): spans are the maximal removed runs of bytes, kept the bytes that are left."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    of = plan(width, total)
    state, parts = _chunks(texts.where("doc_id is not null"), total)
    for step, bucket in enumerate((lambda t: _several(t), lambda t: _earlier(t, "<u8", True), lambda t: _earlier(t, "<u4", False))):
        sent = state.mapInArrow(partial(_sent_rows, of=of, steps=step), _SENT)
        bits = kept(sent.groupBy("bucket").applyInArrow(bucket, _BITS), f"bits-{step}")
        own = bits.repartition(parts, "part").groupBy("part").agg(F.collect_list(F.struct("chunk", "bucket", "bits")).alias(f"bits_{step}"))
        state = state.join(own.hint("shuffle_hash"), "part", "left")
    placeless = texts.where("doc_id is null").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("kept"))
    return state.mapInArrow(partial(_kept_rows, of=of), _OUT).unionByName(placeless)

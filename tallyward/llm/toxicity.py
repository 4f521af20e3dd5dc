"""Toxicity scores from class-conditional Kneser-Ney models.

Two models read words (lower-cased A-Z; runs of ASCII letters and digits and of characters beyond ASCII) byte by byte, each byte after the
`ORDER` - 1 before it in its word: one model of toxic documents, one of ordinary ones.  Each class counts its own full-order grams; all
lower orders are shared by both classes and hold continuation counts (in how many contexts a gram occurs), so an expression that is rare in
both classes backs off to the same estimate in both and says little.  A context that toxic text doesn't have says nothing, nor does a gram that
neither class has: the class of less text only reserves more for what it hasn't seen, and would claim all that is strange.  So a
log-likelihood ratio for each counted gram of the other contexts is the whole model.  All counts are discounted by `DISCOUNT`.

A document's features are its log-likelihood ratio per byte, that of its most toxic word, the sums over its distinct words of what lies
beyond each of the `STRONG` bounds in nats (logarithmic), and the logarithm of its length.  A logistic curve over them, fitted on a fold
that the models did not read, gives the score.  The ratio per byte alone finds a fifth of the toxic documents of sf0.1's held-out fold: a few words in a
long text.

What is learned: grams are counted over all labelled documents of the folds 1 to 4 (crc32 of doc_id as text, modulo 5); fold 0 is held out.
The curve is fitted with models of the folds 1 to 3 on about `FITTED` documents of fold 4 (those below a bound on their hash), where toxic
ones weigh `TOXIC_WEIGHT` times; it then serves the models of all four folds.  Order, discount and weight were chosen on fold 4, among about twenty variants whose
figures on fold 0 were seen beside it.

How: labelled texts are found by a join (a Bloom filter of fixed size spares the shuffle most others), and become sums of gram counts, with
one row for each chunk of text and three bytes before the last.  Dealt by these bytes, all orders from four up are complete in one place, so
one shuffle serves them all; the lower orders are a table of 2^24 rows at most.  Nothing is cut from the counts.  A model of `MODEL_ROWS` rows
at most is broadcast, so that documents are scored where they are read; a larger one is joined to the distinct words of the corpus.

Defined cases: empty and null texts have features of 0 and get what the curve gives them; without both classes in fold 4 every score
is the share of toxic ones in the folds 1 to 4 (0.5 without any); a doc_id with several labels is toxic if one says so; a null doc_id is held out.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import dropped, kept, sampled
from tallyward.llm.textscan import ALNUM, Words, slices

ORDER, DISCOUNT, STRONG = 8, 0.75, (2.5, 4.0)
FITTED, TOXIC_WEIGHT = 20_000, 1.5
#: One for each feature and one constant.
NAMES = ["mean", "top", *(f"strong_{i}" for i in range(len(STRONG))), "length"]
WEIGHTS = len(NAMES) + 1
#: Gram counts of the folds 1 to 3, and of fold 4.
COUNTS = ["toxic", "ordinary", "late_toxic", "late_ordinary"]
#: The models: of the folds 1 to 3, and of all four.
EARLY, WHOLE = "early", "whole"
#: Bytes of text in a chunk, rows that a task holds besides those of one key, rows of a model that is broadcast (12 bytes each).
CHUNK_BYTES, HELD_ROWS, MODEL_ROWS = 1 << 23, 1 << 18, 1 << 24
#: Bits of the Bloom filter of labelled doc_ids, a power of two: 8 MB.
FILTER_BITS = 1 << 26
#: The kinds of a chunk's rows in the path of large models: the words of its documents, a document, a distinct word.
MATRIX, DOCUMENT, WORD = range(3)


def fold() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 5


def word_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The full-order gram at each byte and at the end of some words, and the word of each."""
    size = end - start
    n = size + ORDER  # ORDER - 1 zeros before, a one after
    word = np.repeat(np.arange(len(size)), n)
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) - first[word] - (ORDER - 1)
    inside = (at >= 0) & (at < size[word])
    bytes_ = np.zeros(len(word), np.uint64)
    bytes_[inside] = data[start[word[inside]] + at[inside]]
    bytes_[at == size[word]] = 1
    gram = np.zeros(len(word), np.uint64)
    for k in range(ORDER):
        gram[k:] |= bytes_[: len(bytes_) - k] << np.uint64(8 * k)
    keep = at >= 0
    return gram[keep], word[keep]


def _low(gram: np.ndarray, k: int) -> np.ndarray:
    """The last k bytes."""
    return gram & np.uint64((1 << 8 * k) - 1)


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, and the sums of each of the weights."""
    found, inverse = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(inverse, w, len(found)).astype(np.int64) for w in weights)


def _value(keys: np.ndarray, known: np.ndarray, values: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(known):
        return np.full(len(keys), otherwise)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], otherwise)


def shared_chances(gram: np.ndarray, orders: range, below: np.ndarray | float) -> np.ndarray:
    """The shared estimate of each gram's last byte after the last order - 1 bytes, for the greatest of some orders, from the estimate below.

    The grams are distinct, and all of those that share the last bytes of the least order but for the last one.
    """
    chance = np.broadcast_to(np.asarray(below, float), gram.shape)
    for k in orders:
        found, n = np.unique(_low(np.unique(_low(gram, k + 1)), k), return_counts=True)
        known, total, distinct = _sums(found >> np.uint64(8), n, np.ones(len(n)))
        own = _low(gram, k)
        context = own >> np.uint64(8)
        all_ = _value(context, known, total, 1.0)
        chance = np.maximum(_value(own, found, n, 0.0) - DISCOUNT, 0) / all_ + DISCOUNT * _value(context, known, distinct, 1.0) / all_ * chance
    return chance


def ratios(gram: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, base: np.ndarray | float, orders: range) -> tuple[np.ndarray, np.ndarray]:
    """(gram, ratio) in the contexts of toxic text; base and orders as for `shared_chances`."""
    shared = shared_chances(gram, orders, base)
    context, inverse = np.unique(gram >> np.uint64(8), return_inverse=True)
    chance, totals = [], []
    for counts in (toxic.astype(float), ordinary.astype(float)):
        total = np.bincount(inverse, counts, len(context))
        left = np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1)[inverse]
        back = np.where(total > 0, np.maximum(1 - np.bincount(inverse, left, len(context)), 1e-6), 1.0)
        chance.append(left + back[inverse] * shared)
        totals.append(total)
    keep = (totals[0] > 0)[inverse]
    return gram[keep], np.log(chance[0][keep] / chance[1][keep])


class Model:
    """Grams, sorted, and their ratios."""

    def __init__(self, gram: np.ndarray, ratio: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.ratio = gram[order], ratio[order]

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The log-likelihood ratio of each word."""
        gram, word = word_grams(data, start, end)
        asked, inverse = np.unique(gram, return_inverse=True)  # sorted needles find their places fast
        return np.bincount(word, _value(asked, self.gram, self.ratio, 0.0)[inverse], len(start))


def fit(features: np.ndarray, toxic: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The weights of a logistic regression by Newton's method, with a small ridge; without both classes, a constant."""
    n, t = len(toxic), toxic.sum()
    w = np.zeros(WEIGHTS)
    if t == 0 or t == n:
        w[0] = np.log((t + 0.5) / (n - t + 0.5))
        return w
    scale = features.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(n), features / scale])
    ridge = np.diag([1e-6, *[1.0] * (WEIGHTS - 1)])
    weigh = np.where(toxic > 0, TOXIC_WEIGHT, 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (weigh * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weigh * (p - toxic)) + ridge @ w)
    return np.array([w[0], *(w[1:] / scale)])


def features(text: np.ndarray, ratio: np.ndarray, count: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Of n documents, from their distinct words' documents, ratios and counts."""
    top = np.zeros(n)
    np.maximum.at(top, text, ratio)
    strong = [np.log1p(np.bincount(text, np.where(ratio > STRONG[0], np.maximum(ratio - bound, 0), 0), n)) for bound in STRONG]
    return np.column_stack([np.bincount(text, ratio * count, n) / np.maximum(length, 1), top, *strong, np.log1p(np.bincount(text, count, n))])


# Counting


def _filter_words(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of (one, two), hashes of ids: no more than FILTER_BITS / 64 rows reach the driver."""
    bits = ids.select(F.explode(F.array(*[F.col(x).bitwiseAND(F.lit(FILTER_BITS - 1)) for x in ("one", "two")])).alias("bit"))
    rows = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("held")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows["at"].to_numpy(np.int64)] = rows["held"].to_numpy(np.int64).view(np.uint64)
    return out


def _hashes() -> list[Column]:
    return [F.xxhash64("doc_id").alias("one"), F.xxhash64(F.lit(1), "doc_id").alias("two")]


def _perhaps_labelled(batches, held):
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for x in ("one", "two"):
            bit = np.asarray(batch.column(x)).view(np.uint64) & np.uint64(FILTER_BITS - 1)
            keep &= (held.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        yield batch.select(["doc_id", "text"]).filter(pa.array(keep))


_GRAM_ROWS = "key int, gram array<long>, " + ", ".join(f"{x} array<int>" for x in COUNTS)


def _gram_rows(batches):
    """The grams of each chunk with their counts of each kind, in one row for each key: the three bytes before the last."""
    for batch in batches:
        for rows, data, offs in slices(batch, CHUNK_BYTES):
            words = Words(data, offs, ALNUM, lower=True)
            _, at, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            kind = np.asarray(rows.column("kind"))[words.text_of()]
            gram, word = word_grams(words.data, words.start[at], words.end[at])
            gram, *counts = _sums(gram, *(np.bincount(inverse, kind == c, len(at))[word] for c in range(4)))
            key = _low(gram >> np.uint64(8), 3)
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int), len(key)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (gram[order].view(np.int64), *(c[order].astype(np.int32) for c in counts))]
            yield pa.RecordBatch.from_arrays([pa.array(key[first[:-1]].astype(np.int32)), *lists], names=["key", "gram", *COUNTS])


def gram_counts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, gram, counts of `COUNTS`) of all labelled documents of the folds 1 to 4; marks: (doc_id, toxic, fold), no doc_id twice."""
    learned = marks.where("fold > 0").select("doc_id", (2 * (F.col("fold") == 4).cast("int") + (F.col("toxic") != 1).cast("int")).alias("kind"))
    held = docs.sparkSession.sparkContext.broadcast(_filter_words(learned.select(*_hashes())))
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text", *_hashes())
    texts = texts.mapInArrow(partial(_perhaps_labelled, held=held), docs.select("doc_id", "text").schema)
    rows = texts.join(learned.hint("shuffle_hash"), "doc_id").select("text", "kind").mapInArrow(_gram_rows, _GRAM_ROWS)
    each = rows.repartition("key").select("key", F.explode(F.arrays_zip("gram", *COUNTS)).alias("x")).select("key", "x.*")
    return each.groupBy("key", "gram").agg(*[F.sum(x).alias(x) for x in COUNTS])


# Models


def _low_orders(grams: DataFrame) -> np.ndarray:
    """A matrix of the shared estimates after two bytes: a row of (last three bytes, early, whole) for each three, 2^24 at most."""
    early = (F.col("toxic") + F.col("ordinary") > 0).cast("int").alias("early")
    four = grams.select(F.col("gram").bitwiseAND(F.lit((1 << 32) - 1)).alias("four"), early).groupBy("four").agg(F.max("early").alias("early"))
    three = four.groupBy(F.col("four").bitwiseAND(F.lit((1 << 24) - 1)).alias("three")).agg(F.sum("early").alias("early"), F.count("*").alias("whole")).toPandas()
    own = three["three"].to_numpy(np.int64).astype(np.uint64)
    out = np.zeros((len(own), 2))
    for i, model in enumerate((EARLY, WHOLE)):
        n = three[model].to_numpy(np.int64)
        use = n > 0
        chance = shared_chances(own[use], range(1, 3), 1 / 256)
        context, total, distinct = _sums(own[use] >> np.uint64(8), n[use], np.ones(use.sum()))
        all_ = _value(own[use] >> np.uint64(8), context, total, 1.0)
        out[use, i] = np.maximum(n[use] - DISCOUNT, 0) / all_ + DISCOUNT * _value(own[use] >> np.uint64(8), context, distinct, 1.0) / all_ * chance
    order = np.argsort(own)
    return np.column_stack([own, out])[order]  # 24 bits are exact in a double


def _whole_keys(batches):
    """Cuts rows sorted by key into tables that hold all rows of their keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= HELD_ROWS:
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield rows.slice(0, cut)
                held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _model_rows(batches, low):
    three = low.value[:, 0].astype(np.uint64)
    for rows in _whole_keys(batches):
        gram = rows.column("gram").to_numpy().view(np.uint64)
        counts = {x: rows.column(x).to_numpy() for x in COUNTS}
        of = {EARLY: [counts[c] for c in COUNTS[:2]], WHOLE: [counts[c] + counts[f"late_{c}"] for c in COUNTS[:2]]}
        for i, (model, (toxic, ordinary)) in enumerate(of.items()):
            use = toxic + ordinary > 0
            base = _value(_low(gram[use], 3), three, low.value[:, 1 + i], 1 / 256)
            known, ratio = ratios(gram[use], toxic[use], ordinary[use], base, range(4, ORDER))
            yield pa.RecordBatch.from_arrays([pa.array([model] * len(known)), pa.array(known.view(np.int64)), pa.array(ratio.astype(np.float32))], names=["model", "gram", "ratio"])


def models(grams: DataFrame) -> DataFrame:
    """(model, gram, ratio) of both models."""
    low = grams.sparkSession.sparkContext.broadcast(_low_orders(grams))
    return grams.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_model_rows, low=low), "model string, gram long, ratio float")


def collected(rows: DataFrame) -> Model:
    """A model of `MODEL_ROWS` rows at most in memory."""
    table = rows.select("gram", "ratio").toArrow()
    return Model(table.column("gram").to_numpy().view(np.uint64), table.column("ratio").to_numpy())


# Scores where documents are read


def _scored_rows(batches, model):
    for batch in batches:
        for rows, data, offs in slices(batch, CHUNK_BYTES // 2):
            words = Words(data, offs, ALNUM, lower=True)
            _, at, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            ratio = model.value.words(words.data, words.start[at], words.end[at])
            text, docs = words.text_of(), rows.num_rows
            key, count = np.unique(text.astype(np.int64) * max(len(at), 1) + inverse, return_counts=True)
            length = np.bincount(text, words.end - words.start + 1, docs).astype(np.int64)
            found = features(key // max(len(at), 1), ratio[key % max(len(at), 1)], count, length, docs)
            yield pa.RecordBatch.from_arrays([rows.column("row"), *(pa.array(f) for f in found.T)], names=["row", *NAMES])


def features_in_place(rows: DataFrame, model: Model) -> DataFrame:
    """(row, features); rows: (row, text)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = rows.select("row").schema
    for x in NAMES:
        schema = schema.add(x, "double")
    return rows.mapInArrow(partial(_scored_rows, model=sent), schema)


# Scores of models that are too large to be sent: joins with the distinct words of the corpus


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys as steps and their counts, by planes of bytes, compressed."""
    n = len(keys)
    if not n:
        return bytes(8)
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    raw = np.concatenate([x.view(np.uint8).reshape(n, -1).T.ravel() for x in (steps, counts.astype("<u4"))]).tobytes()
    return n.to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(packed[:8], "little")
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], 12 * n, asbytes=True), np.uint8)
    plane = lambda x, size, kind: np.ascontiguousarray(x.reshape(size, n).T).view(kind).ravel()
    return np.cumsum(plane(raw[: 8 * n], 8, "<u8"), dtype=np.uint64), plane(raw[8 * n :], 4, "<u4").astype(np.int64)


def _chunk_rows(batches):
    """Keys of the matrix are document * number of words + word; nr numbers documents and words in their chunk; a is a word's hash."""
    task, n = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for rows, data, offs in slices(batch, CHUNK_BYTES):
            words = Words(data, offs, ALNUM, lower=True)
            found, at, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            text, docs = words.text_of(), rows.num_rows
            packed = _packed(*np.unique(text.astype(np.uint64) * np.uint64(max(len(found), 1)) + inverse.astype(np.uint64), return_counts=True))
            length = np.bincount(text, words.end - words.start + 1, docs).astype(np.int64)
            spans = [words.data[i:j].tobytes() for i, j in zip(words.start[at], words.end[at], strict=True)]
            sizes = (1, docs, len(found))
            column = lambda kind, *parts: pa.concat_arrays([pa.nulls(m, kind) if x is None else pa.array(x, kind) if not isinstance(x, pa.Array) else x for m, x in zip(sizes, parts, strict=True)])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(sum(sizes), task + n)), pa.array(np.repeat(np.arange(3, dtype=np.int32), sizes)),
                    column(pa.int64(), [0], np.arange(docs), np.arange(len(found))), column(pa.int64(), None, rows.column("a"), found.view(np.int64)),
                    column(pa.int64(), None, rows.column("b"), None), column(pa.int64(), None, length, None), column(pa.binary(), [packed], None, spans),
                ],
                names=["chunk", "kind", "nr", "a", "b", "length", "data"],
            )
            n += 1


def _of_kind(rows: pa.Table, kind: int) -> pa.Table:
    rows = rows.filter(pa.array(np.asarray(rows.column("kind")) == kind))
    return rows.take(pa.array(np.argsort(np.asarray(rows.column("nr")), kind="stable")))


def _positions(batches):
    """The grams of distinct words: one row for each byte and end of a word."""
    for batch in batches:
        column = batch.column("data").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        gram, word = word_grams(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offs[:-1], offs[1:])
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), batch.column("word").take(pa.array(word))], names=["gram", "word"])


def _feature_rows(rows: pa.Table, ratios: pa.Table) -> pa.Table:
    """The features of a chunk's documents."""
    docs, words = _of_kind(rows, DOCUMENT), _of_kind(rows, WORD).num_rows
    keys, count = _unpacked(_of_kind(rows, MATRIX).column("data").to_pylist()[0])
    text, word = (keys // np.uint64(max(words, 1))).astype(np.int64), (keys % np.uint64(max(words, 1))).astype(np.int64)
    ratio = np.zeros(words)
    ratio[np.asarray(ratios.column("at"))] = np.asarray(ratios.column("ratio"))
    found = features(text, ratio[word], count, np.asarray(docs.column("length")), docs.num_rows)
    return pa.table({x: docs.column(x) for x in ("a", "b")} | {x: pa.array(f) for x, f in zip(NAMES, found.T, strict=True)})


def word_ratios(words: DataFrame, model: DataFrame) -> DataFrame:
    """(word, ratio); words: (word, data), no word twice."""
    positions = words.mapInArrow(_positions, "gram long, word long")
    known = positions.join(model.select("gram", "ratio").hint("shuffle_hash"), "gram")
    return known.groupBy("word").agg(F.sum(F.col("ratio").cast("double")).alias("ratio"))


def features_by_joins(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(row, features); rows: (row, text)."""
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]  # on which alone features depend
    chunks = kept(rows.select("text", *key).mapInArrow(_chunk_rows, "chunk long, kind int, nr long, a long, b long, length long, data binary"), "chunks")
    words = chunks.where(F.col("kind") == WORD).groupBy(F.col("a").alias("word")).agg(F.first("data").alias("data"))
    own = chunks.where(F.col("kind") == WORD).select(F.col("chunk").alias("of"), F.col("nr").alias("at"), F.col("a").alias("word"))
    own = own.join(word_ratios(words, model).hint("shuffle_hash"), "word").drop("word")
    found = chunks.groupBy("chunk").cogroup(own.groupBy("of")).applyInArrow(_feature_rows, "a long, b long, " + ", ".join(f"{x} double" for x in NAMES))
    found = kept(found.groupBy("a", "b").agg(*[F.first(x).alias(x) for x in NAMES]), "features")
    return rows.select("row", *key).join(found.hint("shuffle_hash"), ["a", "b"]).select("row", *NAMES)


def scored(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(row, score): row is the struct of the document's columns (or some of them), score from 0 to 1, higher where toxic is likelier."""
    marks = labels.where("doc_id is not null and toxic is not null").withColumn("fold", fold())
    marks = marks.groupBy("doc_id", "fold").agg(F.max("toxic").cast("int").alias("toxic"))
    grams = kept(gram_counts(docs, marks), "grams")
    model = kept(models(grams), "model")
    dropped(grams)
    sizes = {r["model"]: r["count"] for r in model.groupBy("model").count().collect()}

    def found(rows: DataFrame, name: str) -> DataFrame:
        part = model.where(F.col("model") == name)
        return features_in_place(rows, collected(part)) if sizes.get(name, 0) <= MODEL_ROWS else features_by_joins(rows, part)

    late = marks.where("fold = 4")
    few = late.where(sampled(F.xxhash64("doc_id"), FITTED, late.count())).select("doc_id", "toxic")  # about FITTED rows at most
    texts = docs.join(F.broadcast(few), "doc_id").select(F.struct("doc_id", "toxic").alias("row"), "text")
    one = found(texts, EARLY).groupBy("row.doc_id").agg(F.min(F.struct("row.toxic", *NAMES)).alias("x")).select("x.*").toPandas()
    if one["toxic"].nunique() == 2:
        constant, *weights = fit(one[NAMES].to_numpy(float), one["toxic"].to_numpy(float)).tolist()
    else:
        n, t = marks.where("fold > 0").agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        constant, weights = float(np.log((t + 0.5) / (n - t + 0.5))), [0.0] * len(NAMES)
    sum_ = sum((F.lit(w) * F.col(x) for w, x in zip(weights, NAMES, strict=True)), F.lit(constant))
    score = 1 / (1 + F.exp(-F.greatest(F.least(sum_, F.lit(30.0)), F.lit(-30.0))))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns or docs.columns]).alias("row"), "text")
    return found(rows, WHOLE).select("row", score.alias("score"))

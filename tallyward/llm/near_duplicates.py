"""Near-duplicate documents: fast similarity sketches, banding, and exact verification on full shingle sets.

A document's set holds its distinct k-word shingles; with fewer words, all of them as one; without words it is empty and linked with
nothing.  Two documents are linked if `parts` * intersection >= `of` * union.  A component is what links reach.

Method.
1. Sketch.  In round i each shingle is hashed to one of the bins and offers i plus its hash there; the least offer stays.  After as many
   rounds as there are bins, round i serves bin i - bins alone, so every bin fills.  Full documents leave after the round that fills them.
2. Equal sets form a class, named by its smallest doc_id; from here on a class is one document.
3. Banding.  Bins form bands; classes that share a band meet in a bucket.  A bucket's hub is its smallest class.  All pairs of a bucket
   lie in the group of its hub, so the distinct pairs (hub, class) hold every candidate pair, one row for each class and hub.
4. Verification.  A hub's group is dealt to tiles of a bounded number of shingles.  A tile counts all its intersections exactly, as a product of
   its shingle matrix with itself, and keeps the links that join its parts.  Groups of one tile are then complete.
5. Larger groups: the first tiles' links give components.  Only pairs of tiles are counted of which one holds classes outside its
   hub's component, and whose distances to the hub differ by no more than a link allows (Jaccard distance is a metric).  Pairs of tiles are
   dealt by ring and salt.  Documents that all share half of a template or so stay quadratic in such a group: they share bands, but no links.

At a similarity of 0.8 a pair misses all 32 bands of 4 bins with probability 5e-8.  Verification is on 64-bit shingle hashes of whole
texts.  Null texts are empty.  Rows that repeat a doc_id with the same text belong to one node; further rows with another text are
resolved for their own text.  Rows with a null doc_id keep their number of shingles, have a null component_id, and link nothing.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.shared import kept
from tallyward.llm.textscan import Words, combine, inner_starts, mix, rolling, slices

BINS, BAND = 128, 4
#: Shingles and documents in a tile, at most (one document may be larger).
TILE_SHINGLES, TILE_DOCS = 400_000, 512
#: Tiles of a hub that a task pairs with others.
PAIRED_TILES = 64


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and the index of each text's first (and the end)."""
    h = words.hashes()
    start, text = inner_starts(words.first, k)
    value = rolling(h, k)[start] if len(start) else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):  # the whole sequence, told apart from shingles by its length
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = words.counts[short] > j
            whole[has] = combine(whole[has], h[words.first[:-1][short[has]] + j])
        value, text = np.concatenate([value, mix(whole)]), np.concatenate([text, short])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(words.offs)))


def sketches(value: np.ndarray, first: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of `bins` coordinates for each set; rows of empty sets stay at the largest value."""
    n = len(first) - 1
    out = np.full((n, bins), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    open_sets = np.flatnonzero(np.diff(first) > 0)
    rows = np.repeat(np.arange(n), np.diff(first))
    values = value
    for turn in range(2 * bins):
        if not len(open_sets):
            break
        h = mix(values ^ np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & (1 << 64) - 1))
        bin_ = (h >> np.uint64(40)) % np.uint64(bins) if turn < bins else np.uint64(turn - bins)
        offer = (np.uint64(turn) << np.uint64(56)) | (h & np.uint64((1 << 56) - 1))
        np.minimum.at(flat, (rows * bins + bin_.astype(np.int64) if turn < bins else rows * bins + (turn - bins)), offer)
        full = np.ones(n, bool)
        full[open_sets] = (out[open_sets] != np.iinfo(np.uint64).max).all(axis=1)
        stay = ~full[rows]
        rows, values, open_sets = rows[stay], values[stay], np.flatnonzero(~full)
    return out


def band_keys(sketch: np.ndarray, band: int = BAND) -> np.ndarray:
    parts = sketch.reshape(len(sketch), -1, band)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(band):
        key = combine(key, parts[:, :, j])
    return key


def _feature_rows(batches, k: int):
    for batch in batches:
        for rows, data, offs in slices(batch):
            value, first = shingle_sets(Words(data, offs, lower=True), k)
            n = np.diff(first)
            keys = band_keys(sketches(value, first)).view(np.int64)
            sums = np.zeros((2, len(n)), np.uint64)
            for s, v in enumerate((value, mix(value ^ np.uint64(0xABCDEF)))):  # sums of well-mixed hashes name a set
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(v), dtype=np.uint64)])
                sums[s] = total[first[1:]] - total[first[:-1]]
            width = keys.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(0, width * len(n) + 1, width, dtype=np.int32), keys.reshape(-1))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_hash"), n.astype(np.int64), *sums.view(np.int64), lists], names=["doc_id", "text_hash", "n_shingles", "one", "two", "bands"])


def _set_rows(batches, k: int):
    """Each document's set, once for each (hub, tiles) that it is listed with."""
    for batch in batches:
        for rows, data, offs in slices(batch):
            value, first = shingle_sets(Words(data, offs, lower=True), k)
            ids = np.asarray(rows.column("doc_id"))
            bounds = first * 8
            raw = value.tobytes()
            sets = [raw[bounds[i] : bounds[i + 1]] for i in range(len(ids))]
            out = [(h["hub"], h["tile"], i, s) for i, s, hubs in zip(ids.tolist(), sets, rows.column("hubs").to_pylist(), strict=True) for h in hubs]
            hub, tile, doc, held = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(tile, pa.int32()), pa.array(doc, pa.int64()), pa.array(held, pa.binary())], names=["hub", "tile", "doc_id", "held"])


def intersections(sets: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """The sizes of all pairwise intersections, as products of 0/1 matrices over blocks of the shingles that two sets have at least."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    rank = np.cumsum(new) - 1
    many = np.bincount(rank) > 1 if len(rank) else np.zeros(0, bool)
    keep = many[rank] if len(rank) else np.zeros(0, bool)
    rank, owner = (np.cumsum(many) - 1)[rank[keep]], owner[keep]
    out = np.zeros((n, n), np.float64)
    for low in range(0, int(many.sum()), step):
        lo, hi = np.searchsorted(rank, [low, low + step])
        block = np.zeros((n, step), np.float32)
        block[owner[lo:hi], rank[lo:hi] - low] = 1
        out += block @ block.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _similar(sets: list[np.ndarray], parts: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    both = intersections(sets)
    size = np.diag(both)
    union = size[:, None] + size[None, :] - both
    return (parts * both >= of * union) & (both > 0), both / np.maximum(union, 1)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(member, first of its part) for the parts that links join."""
    n, seen, out = len(linked), np.zeros(len(linked), bool), []
    for i in range(n):
        if not seen[i]:
            part = np.zeros(n, bool)
            part[i] = True
            front = part.copy()
            while front.any():
                reach = linked[front].any(axis=0) & ~part
                part |= reach
                front = reach
            seen |= part
            out += [(int(j), i) for j in np.flatnonzero(part) if j != i]
    return out


def _members(group: pa.Table, hub: int | None) -> tuple[list[int], list[np.ndarray]]:
    """Ids and sets, without repeated rows."""
    rows = set(zip(group.column("doc_id").to_pylist(), group.column("held").to_pylist(), strict=True))
    rows = sorted(rows, key=lambda x: (x[0] != hub, x[0]))
    return [i for i, _ in rows], [np.frombuffer(x, np.uint64) for _, x in rows]


_LINKS = "hub long, tile int, a long, b long, distance double"


def _own_rows(key, group: pa.Table, parts: int, of: int) -> pa.Table:
    """A tile's links, and each member's distance to the hub (in rows whose a is the member and b is null)."""
    hub, tile = key[0].as_py(), key[1].as_py()
    ids, sets = _members(group, hub)  # the hub comes first
    linked, near = _similar(sets, parts, of)
    out = [(hub, tile, ids[a], ids[b], None) for a, b in _forest(linked)] + [(hub, tile, i, None, 1 - float(s)) for i, s in zip(ids, near[0], strict=True)]
    return _table(out)


def _cross_rows(key, group: pa.Table, parts: int, of: int) -> pa.Table:
    """Links between two tiles of one hub."""
    ids, sets = _members(group, None)
    linked, _ = _similar(sets, parts, of)
    return _table([(key[0].as_py(), -1, ids[a], ids[b], None) for a, b in _forest(linked)])


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["hub", "tile", "a", "b", "distance"])


def near_duplicates(docs: DataFrame, k: int = 5, parts: int = 100, of: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash: xxhash64 of the text) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = rows.where("doc_id is not null")
    features = kept(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(partial(_feature_rows, k=k), "doc_id long, text_hash long, n_shingles long, one long, two long, bands array<long>"), "features")
    classes = features.where("n_shingles > 0 and doc_id is not null").groupBy("one", "two").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("size"), F.min_by("bands", "doc_id").alias("bands"))
    classes = kept(classes, "classes")

    # (hub, rep): the classes of each bucket that more than one class is in
    bands = classes.select("rep", "size", F.explode("bands").alias("band"))
    buckets = kept(bands.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "hub"), "buckets")
    pairs = kept(bands.join(buckets, "band").select("hub", "rep", "size").distinct(), "pairs")

    links = _verified(texts, pairs, k, parts, of)
    roots = components(links.select("a", "b"))
    resolved = kept(classes.select("one", "two", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("one", "two", F.coalesce("root", "rep").alias("root")), "resolved")
    return features.drop("bands").join(resolved, ["one", "two"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"), "text_hash")


def _dealt(members: DataFrame, n_tiles) -> DataFrame:
    return members.withColumn("tile", F.pmod(F.xxhash64("rep", "hub"), n_tiles).cast("int"))


def _sets(texts: DataFrame, listed: DataFrame, k: int) -> DataFrame:
    """The sets of the listed (hub, tile, rep)."""
    hubs = listed.groupBy(F.col("rep").alias("doc_id")).agg(F.collect_set(F.struct("hub", "tile")).alias("hubs"))
    return texts.join(hubs.hint("shuffle_hash"), "doc_id").mapInArrow(partial(_set_rows, k=k), "hub long, tile int, doc_id long, held binary")


def _verified(texts: DataFrame, pairs: DataFrame, k: int, parts: int, of: int) -> DataFrame:
    sizes = pairs.groupBy("hub").agg(F.sum("size").alias("all"), F.count("*").alias("n"))
    sizes = kept(sizes.select("hub", F.greatest(F.ceil(F.col("all") / TILE_SHINGLES), F.ceil(F.col("n") / TILE_DOCS)).alias("tiles")), "sizes")
    dealt = _dealt(pairs.join(sizes, "hub"), F.col("tiles"))
    # the hub itself is in every tile, so that each tile knows its members' distances to it
    whole = sizes.select("hub", F.col("hub").alias("rep"), F.explode(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1)).alias("tile"))
    listed = dealt.where("rep != hub").select("hub", "rep", "tile").unionByName(whole)
    sets = kept(_sets(texts, listed, k), "sets")
    found = kept(sets.groupBy("hub", "tile").applyInArrow(lambda key, tile: _own_rows(key, tile, parts, of), _LINKS), "found")
    links = found.where("b is not null")
    large = kept(sizes.where("tiles > 1"), "large")
    if large.isEmpty():
        return links

    # what the first tiles of large groups have left open
    roots = kept(components(links.select("a", "b")), "roots")
    far = found.where("b is null").join(large, "hub").select("hub", F.col("a").alias("rep"), "distance").distinct()
    named = far.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    hubs = large.select(F.col("hub").alias("node")).join(roots, "node", "left").select(F.col("node").alias("hub"), F.coalesce("root", "node").alias("hub_root"))
    named = named.join(kept(hubs, "hubs"), "hub").select("hub", "rep", (F.col("root") == F.col("hub_root")).alias("settled"), F.floor(F.col("distance") * 20).cast("int").alias("ring"))
    named = kept(named.join(pairs, ["hub", "rep"]), "named")
    parts_of = named.groupBy("hub", "settled", "ring").agg(F.greatest(F.ceil(F.sum("size") / (TILE_SHINGLES // 2)), F.ceil(F.count("*") / (TILE_DOCS // 2))).alias("tiles"))
    parts_of = kept(parts_of, "rings")
    numbers = parts_of.select("hub", "settled", "ring", F.explode(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1)).alias("number"))
    label = F.struct("settled", "ring", "number")
    numbers = numbers.select("hub", "settled", "ring", label.alias("label"))
    reach = (parts - of) * 20 // parts + 2  # rings that a link can span
    # labels meet by ring; one side is dealt over salts, as many as its hub's tiles ask for, the other is copied to each
    salts = kept(parts_of.groupBy("hub").agg(F.ceil(F.sum("tiles") / PAIRED_TILES).cast("int").alias("salts")), "salts")
    salted = numbers.join(salts, "hub")
    mine = salted.select("hub", "settled", "label", F.pmod(F.xxhash64("label"), F.col("salts")).cast("int").alias("salt"), F.explode(F.sequence(F.col("ring") - reach, F.col("ring") + reach)).alias("ring"))
    other = salted.select("hub", "ring", F.col("settled").alias("settled_2"), F.col("label").alias("label_2"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    crossing = mine.join(other, ["hub", "ring", "salt"]).where((F.col("label") <= F.col("label_2")) & ~(F.col("settled") & F.col("settled_2")))
    crossing = kept(crossing.select("hub", F.xxhash64("hub", "label", "label_2").cast("string").alias("cross"), "label", "label_2"), "crossing")
    sides = crossing.select("hub", "cross", F.col("label")).unionByName(crossing.select("hub", "cross", F.col("label_2").alias("label"))).distinct()
    member = named.join(parts_of, ["hub", "settled", "ring"]).withColumn("number", F.pmod(F.xxhash64("rep", "hub"), F.col("tiles")).cast("int"))
    member = kept(member.select("hub", "rep", label.alias("label")), "members")
    sets = sets.join(large, "hub", "left_semi").where("doc_id != hub or tile = 0")  # a hub's set lies in each of its tiles
    placed = member.join(sides, ["hub", "label"]).select("hub", "cross", F.col("rep").alias("doc_id"))
    tiles = placed.join(sets.select("hub", "doc_id", "held"), ["hub", "doc_id"])
    more = tiles.groupBy("hub", "cross").applyInArrow(lambda key, tiles: _cross_rows(key, tiles, parts, of), _LINKS)
    return links.unionByName(kept(more, "more"))

"""Secret scans in DataFrame functions alone: fixed patterns, and character Markov models for what they don't name.

Base spans come from three patterns, leftmost and without overlap within a kind.  Positions are counted in characters: splitting a text
at its matches gives the gaps between them, and gaps and matches alternate, so running sums of their lengths give the starts.  Sums run
over blocks of `BLOCK` matches and over the blocks' sums, so a text of very many matches costs little more than one of few.

Further spans, kind `random`: runs of `CANDIDATE` characters that overlap no base span, for which a first-order Markov model of random
strings is likelier than one of ordinary identifiers by `MARGIN` nats a character or more.  Both models are trained from labelled samples
of the same documents.  Random: about `SAMPLE` strings that the base patterns name, and their digests in the alphabets that secrets are
written in (base64, its URL form, upper-case hex), as the named ones alone may know one alphabet.  Ordinary: the tokens, shorter than a
candidate, of about `SAMPLE_DOCS` documents without their base spans, and identifiers made of about `PAIRS` pairs of neighbouring words (snake,
kebab and camel case, constants, paths, numbers, dates).  Samples are those below a bound on their hash (all, if there are fewer).  A character's
counts after another one are smoothed by `PRIOR` times its share of all characters.  The model is a table of a fixed size.

Defined cases: null texts are empty and have no spans; repeated rows are judged each for itself; without words in the sample nothing is
added; without secrets random strings are uniform.  Each text is read once from start to end, whatever its length and its runs' lengths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import kept, sampled

#: The base patterns with the group that is measured and its least length, in the order of kinds.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
#: As hex and access runs are maximal, the least length can be part of the pattern that is searched.
_SEARCHED = {"assign": KINDS["assign"][0], "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
MARGIN, PRIOR, SAMPLE, SAMPLE_DOCS, PAIRS, BLOCK = 1.5, 10.0, 20_000, 2_000, 50_000, 256
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_N = len(ALPHABET) + 1  # 0 is the start, and whatever isn't in the alphabet
_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(sizes: Column) -> Column:
    """For each of some integers, the sum of it and all before it."""
    fold = lambda items, start: F.get(
        F.array(F.aggregate(items, F.struct(start.alias("at"), F.array().cast("array<int>").alias("sums")), lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["sums"], F.array(s["at"] + x)).alias("sums")))), 0
    )["sums"]

    def blocks(all_: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda i: F.slice(all_, i * BLOCK + 1, F.lit(BLOCK)))
        return _let(cut, lambda parts: _let(fold(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x)), F.lit(0)), lambda ends: F.flatten(F.transform(parts, lambda p, i: fold(p, F.when(i > 0, F.get(ends, i - 1)).otherwise(0))))))

    return _let(sizes, lambda all_: F.when(F.size(all_) > 0, blocks(all_)).otherwise(F.array().cast("array<int>")))


def _found(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """The matches of a pattern: (start, kind, end, value of the measured group)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole).alias("value"))
    # the last gap has no match after it
    parts = F.filter(parts, lambda p: p["whole"].isNotNull())

    def spans(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: F.char_length(p["gap"]) + F.char_length(p["whole"])))
        return F.zip_with(parts, ends, lambda p, end: F.struct((end - F.char_length(p["whole"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["value"].alias("value")))

    spans = F.filter(_let(parts, spans), lambda s: F.char_length(s["value"]) >= least).cast(_SPANS)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _codes(word: Column) -> Column:
    return F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _counts(words: DataFrame, n: str = "1") -> dict[int, int]:
    """How often each character's code follows each other's (0 before the first), as one number: no more rows than the table has cells."""
    distinct = words.where("word != ''").groupBy("word").agg(F.sum(F.expr(n)).alias("n"))
    letters = distinct.select(F.split("word", "").alias("b"), "n")
    pairs = letters.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), F.slice("b", 1, F.size("b") - 1)).alias("a"), "b")).alias("x"), "n")
    code = lambda c: F.when(c != "", F.instr(F.lit(ALPHABET), c)).otherwise(0)
    cells = pairs.groupBy((code(F.col("x.a")) * _N + code(F.col("x.b"))).alias("cell")).agg(F.sum("n").alias("n"))
    return {r["cell"]: r["n"] for r in cells.collect()}


def _log_chances(counts: dict[int, int]) -> list[float]:
    """Of each cell: a character's share after another one, smoothed by `PRIOR` times its share of all characters."""
    share = [sum(counts.get(a * _N + b, 0) for a in range(_N)) + 0.5 for b in range(_N)]
    after = [sum(counts.get(a * _N + b, 0) for b in range(_N)) for a in range(_N)]
    return [math.log((counts.get(a * _N + b, 0) + PRIOR * share[b] / sum(share)) / (after[a] + PRIOR)) for a in range(_N) for b in range(_N)]


def _log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    return [round(r - o, 4) for r, o in zip(_log_chances(random), _log_chances(ordinary), strict=True)]


def random_strings(values: DataFrame) -> DataFrame:
    """Labelled secrets, and their digests in other alphabets; values: (word)."""
    digest = F.sha2("word", 256)
    base64 = F.rtrim(F.base64(F.unhex(digest)), F.lit("="))
    return values.select(F.explode(F.array("word", base64, F.translate(base64, "+/", "-_"), F.upper(digest))).alias("word"))


def identifiers(texts: DataFrame) -> DataFrame:
    """(word, n): the tokens of some texts, and identifiers made of neighbouring words; texts: (text), without base spans and candidates.

    Of the distinct pairs of neighbours about `PAIRS` are made identifiers, each of which counts for as many pairs as it stands for.
    """
    words = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]+"), F.lit(0))
    tokens = texts.select(words.alias("words")).select("words", F.filter("words", lambda w: w.rlike("^[A-Za-z]+$")).alias("plain"))
    alone = F.arrays_zip(F.col("words").alias("a"), F.array().cast("array<string>").alias("b"))
    neighbours = F.arrays_zip(F.slice("plain", 1, F.greatest(F.size("plain") - 1, F.lit(0))).alias("a"), F.slice("plain", 2, F.size("plain")).alias("b"))
    counted = kept(tokens.select(F.explode(F.concat(alone, neighbours)).alias("x")).groupBy("x.a", "x.b").agg(F.count("*").alias("n")), "tokens")
    pairs = counted.where("b is not null")
    found = pairs.count()
    a, b, n = F.lower("a"), F.lower("b"), F.crc32(F.concat("a", F.lit(" "), "b"))
    day = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (n % 18000).cast("int")), "yyyy-MM-dd")
    number = (n % 1000).cast("string")
    styles = [F.concat_ws("_", a, b), F.concat_ws("-", a, b), F.concat_ws("/", a, b, F.initcap("a")), F.concat(F.initcap("a"), F.initcap("b")), F.concat(a, F.initcap("b")), F.concat_ws("_", F.upper("a"), F.upper("b")), F.concat_ws("-", day, a), F.concat(a, number, F.lit("_v"), number.substr(1, 1))]
    made = pairs.where(sampled(F.xxhash64("a", "b"), PAIRS, found)).select(F.explode(F.array(*styles)).alias("word"), F.lit(max(1, round(found / PAIRS))).cast("long").alias("n"))
    return counted.where("b is null").select(F.col("a").alias("word"), "n").unionByName(made)


def train(docs: DataFrame, found: DataFrame) -> list[float]:
    """The table of log-likelihood ratios; found: the base spans of docs."""
    n_docs, n_values = found.agg(F.count("*"), F.coalesce(F.sum(F.size("base")), F.lit(0))).first()
    values = found.select(F.explode("base.value").alias("word")).where(sampled(F.xxhash64("word"), SAMPLE, n_values))
    text = F.col("text")
    for pattern in (*_SEARCHED.values(), CANDIDATE):
        text = F.regexp_replace(text, pattern, " ")
    texts = docs.select("doc_id", "text").where(sampled(F.xxhash64("doc_id", "text"), SAMPLE_DOCS, n_docs)).select(text.alias("text"))
    ordinary = _counts(identifiers(texts), "n")
    return _log_ratios(_counts(random_strings(values)), ordinary) if ordinary else [-1.0] * _N * _N


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): array of (start, kind, end, value), sorted; kind is a name of `KINDS`, or `random`."""
    text = F.coalesce("text", F.lit(""))
    kinds = [_found(text, _SEARCHED[name], i, group, least) for i, (name, (_, group, least)) in enumerate(KINDS.items())]
    base = docs.select("doc_id", F.array_sort(F.concat(*kinds)).alias("base"), _found(text, CANDIDATE, len(KINDS), 0, 1).alias("more"))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    base = kept(base.select("doc_id", "base", apart.alias("more")), "base")
    table = F.split(F.lit(",".join(map(str, train(docs, base)))), ",").cast("array<double>")

    def ratio(span: Column) -> Column:
        begun = F.struct(F.lit(0).alias("code"), F.lit(0.0).alias("total"))
        step = lambda s, code: F.struct(code.alias("code"), (s["total"] + F.get(table, s["code"] * _N + code)).alias("total"))
        return F.aggregate(_codes(span["value"]), begun, step)["total"] / F.char_length(span["value"])

    spans = F.array_sort(F.concat("base", F.filter("more", lambda m: ratio(m) >= MARGIN)))
    names = F.array(*[F.lit(k) for k in (*KINDS, "random")])
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return base.select("doc_id", named.alias("spans"))

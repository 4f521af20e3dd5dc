"""URL filters: a list of host and path rules, and association rules mined by FP-growth for the pages that no listed rule fits.

Labels are the listed rules' own verdicts: pages that one fits are the labelled transactions, their items the URL's tokens and the verdict.
What the list itself tests (domains, and path segments of its rules) is no token, else the list would only be learned back.
Token combinations that imply `block` with at least `CONFIDENCE` and `LIFT`, in at least a share `SUPPORT` of the transactions, are kept (all
three are shares, so the same mix of URLs gets the same verdicts at every size); of those, combinations that hold a smaller kept one are pruned.  An inverted index files each rule under its rarest token; a page meets the
rules of its tokens there and is blocked if all of a rule's tokens are its own.  Everything else is allowed.

Tokens: the host's labels before its last two, path segments with runs of digits as 0, and keys of the query.

Defined cases: a null url, or one without ://, has an empty host and path, no tokens, and is allowed; without labelled pages there are no
mined rules; repeated rows get the same verdict; ports and users in a url are part of its host; a url of any length is judged whole, and each of its tokens counts once.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.shared import kept

#: Fixed values: (verdict, host, start of the path).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
SUPPORT, CONFIDENCE, LIFT = 0.02, 0.9, 1.1
_BLOCK, _ALLOW = "=block", "=allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, _PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, _PARTS, 2)


def tokens(rules=RULES) -> Column:
    """The distinct tokens of a row with url, host and path."""
    tested = [x for _, _, path in rules for x in path.split("/") if x]
    labels = F.split("host", r"\.")
    named = F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.filter(F.split("path", "/"), lambda x: (x != "") & ~x.isin(tested)), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    keys = F.transform(F.regexp_extract_all(F.regexp_extract("url", _PARTS, 3), F.lit("(?:^|&)([^=&]+)"), F.lit(1)), lambda x: F.concat(F.lit("q:"), x))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(named, segments, keys)))


def listed(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages with host, path, and the longest fitting rule and its verdict (null if none fits)."""
    host, path = host_and_path(F.col("url"))
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return pages.withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("listed", verdict)


def mined(judged: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(tokens): minimal token combinations that imply a block; judged: rows of `listed`."""
    label = F.when(F.col("listed") == "block", _BLOCK).otherwise(_ALLOW)
    items = kept(judged.where("listed is not null").select(F.array_append(tokens(rules), label).alias("items")), "transactions")
    if items.isEmpty():
        return items.sparkSession.createDataFrame([], "tokens array<string>")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0] == _BLOCK).where(~F.array_contains("antecedent", _ALLOW))
    found = found.where(F.col("lift") >= LIFT)
    found = kept(found.select(F.array_sort("antecedent").alias("tokens")), "rules")
    # a rule is redundant if another one's tokens are a part of its own
    smaller = found.select(F.col("tokens").alias("part"), F.col("tokens")[0].alias("token"))
    larger = found.select("tokens", F.explode("tokens").alias("token"))
    within = (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    return found.join(larger.join(smaller, "token").where(within).select("tokens").distinct(), "tokens", "left_anti")


def blocked(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url) of the rows (url, tokens) that a rule of tokens fits, by an inverted index of the rules."""
    known = rules.select("tokens", F.explode("tokens").alias("token"))
    rarity = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    index = known.join(rarity, "token").groupBy("tokens").agg(F.min_by("token", F.struct("n", "token")).alias("token")).withColumnRenamed("tokens", "rule")
    meets = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(kept(index, "index"), "token")
    return meets.where(F.size(F.array_except("rule", "tokens")) == 0).select("url").distinct()


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict)."""
    judged = listed(pages.select("page_id", "url"), rules)
    urls = kept(judged.where("listed is null and host != ''").select("url", tokens(rules).alias("tokens")).distinct(), "urls")
    bad = kept(blocked(urls, kept(mined(judged, rules), "mined")), "blocked").withColumn("bad", F.lit(True))
    verdict = F.coalesce("listed", F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.join(bad, "url", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))

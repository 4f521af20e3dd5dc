"""The life of flags from run to run: detected, resolved, opened again; and what reviewers say about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.flags import unpiped

KEYS = ("subject", "displayed_form", "displayed_timepoint", "displayed_variable", "error_message")
REVIEW = ("manually_resolved", "comments", "site_comments")


def step(old: DataFrame, new: DataFrame, run_date: Column, keys=KEYS, remove: Column | None = None) -> DataFrame:
    """The flags after a run.

    Only new: detected now.  Only old: resolved now, unless it was already (or dropped where `remove` holds).  Both: open, detected again if it was
    resolved; the reviewers' columns are the old ones.  Both sides are made unique on the keys first, so the join multiplies nothing: of rows
    with equal keys the one of the least seq stays, then of the least hash of its columns.  The age counts days since the last detection;
    old rows without a detection keep none.
    """
    if "flag_key" in old.columns:
        new = keyed(_unique(new, keys), keys)
        both = old.alias("o").join(new.alias("n"), F.col("o.flag_key") == F.col("n.flag_key"), "full")
    else:
        both = _unique(old, keys).alias("o").join(_unique(new, keys).alias("n"), [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full")
    was, now = F.col("o.dates_detected").isNotNull(), F.col("n.dates_detected").isNotNull()
    resolved = F.coalesce(F.col("o.currently_resolved"), F.lit(False))
    today = F.array(run_date.cast("date"))
    none = F.array().cast("array<date>")
    detected = F.when(~was, today).when(now & resolved, F.concat("o.dates_detected", today)).otherwise(F.col("o.dates_detected"))
    ended = F.when(~was, none).when(~now & ~resolved, F.concat("o.dates_resolved", today)).otherwise(F.col("o.dates_resolved"))
    taken = {"dates_detected": detected, "dates_resolved": ended, "currently_resolved": ~now}
    taken |= {x: F.coalesce(F.col(f"o.{x}"), F.col(f"n.{x}")) for x in REVIEW if x in old.columns and x in new.columns}
    kept = both.where(~(was & ~now & remove)) if remove is not None else both
    plain = [x for x in new.columns if x not in taken and x in old.columns and x != "time_since_last_detection"]
    out = kept.select(*[F.expr(f"CASE WHEN n.dates_detected IS NOT NULL THEN n.`{x}` ELSE o.`{x}` END AS `{x}`") for x in plain], *[e.alias(x) for x, e in taken.items()])
    return out.withColumn("time_since_last_detection", F.datediff(run_date.cast("date"), F.element_at("dates_detected", -1)))


def keyed(flags: DataFrame, keys=KEYS) -> DataFrame:
    """Adds flag_key, a digest of a flag's keys in which nulls differ from texts."""
    return flags.withColumn("flag_key", F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))


def _unique(flags: DataFrame, keys) -> DataFrame:
    """Flags are dealt before they are put in order, so that they are sorted once; those of a form of a visit stay together, as trackers take them."""
    rest = [x for x in flags.columns if x not in keys]
    order = F.struct(*([F.col("seq")] if "seq" in rest else []), F.xxhash64(*rest))
    dealt = flags.repartition(*[k for k in keys if k in KEYS[:3]] or keys)
    return dealt.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*") if rest else flags.distinct()


def history(runs: DataFrame, present: DataFrame, key: str, run: str) -> DataFrame:
    """W2 for a whole history at once: each stretch of runs in which a flag was present, and the run that resolved it (null if none did).

    runs: (run), all run numbers in order; present: (key, run).
    """
    ordered = runs.select(run).distinct()
    numbered = ordered.withColumn("number", F.row_number().over(Window.orderBy(run)))  # one row for each run
    seen = present.select(key, run).distinct().join(F.broadcast(numbered), run)
    w = Window.partitionBy(key).orderBy("number")
    marked = seen.withColumn("stretch", F.col("number") - F.row_number().over(w))
    found = marked.groupBy(key, "stretch").agg(F.min(run).alias("detected"), F.max("number").alias("last"), F.count("*").alias("runs"))
    following = numbered.select((F.col("number") - 1).alias("last"), F.col(run).alias("resolved"))
    return found.join(F.broadcast(following), "last", "left").select(key, "detected", "resolved", "runs")


def review_rows(sheet: DataFrame) -> DataFrame:
    """A reviewer's sheet with one row for each flag text; a text that a sheet repeats counts once, by its least comments."""
    rows = sheet.withColumn("error_message", F.explode(unpiped("flags"))).withColumn("error_message", F.trim("error_message"))
    return rows.groupBy("subject", "displayed_timepoint", "displayed_form", "error_message").agg(*[F.min(x).alias(f"sheet_{x}") for x in REVIEW])


def reviewed(flags: DataFrame, sheet: DataFrame) -> DataFrame:
    """Subjects that a sheet lists take its columns (blank where it has no such flag); others keep theirs."""
    rows = review_rows(sheet)
    listed = sheet.select("subject").distinct().withColumn("_listed", F.lit(True))
    out = flags.join(rows, ["subject", "displayed_timepoint", "displayed_form", "error_message"], "left").join(listed, "subject", "left")
    taken = {x: F.when(F.col("_listed"), F.coalesce(F.col(f"sheet_{x}"), F.lit(""))).otherwise(F.col(x)) for x in REVIEW}
    return out.withColumns(taken).drop("_listed", *[f"sheet_{x}" for x in REVIEW])

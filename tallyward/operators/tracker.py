"""Trackers: flags merged to one row for each form of a visit, ordered, classed, and dealt to reports and sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as v
from tallyward.operators.flags import of_reports

GROUP = ("subject", "displayed_timepoint", "displayed_form", "currently_resolved", "manually_resolved")


def in_order(text: str, seq: str) -> Column:
    """The distinct texts of a group in the order of their sequence numbers, as one text."""
    pairs = F.array_sort(F.collect_set(F.struct(F.col(seq).alias("seq"), F.col(text).alias("text"))))
    return F.array_distinct(F.transform(pairs, lambda p: p["text"]))


def merged(flags: DataFrame, keys=GROUP, seq: str = "seq") -> DataFrame:
    """Messages and labels joined uniquely in order, the largest age, any priority, the first of the rest, and the number of messages."""
    messages = in_order("error_message", seq)
    out = [F.array_join(messages, " | ").alias("flags"), F.size(messages).cast("long").alias("flag_count")]
    if "label" in flags.columns:
        out.append(F.array_join(in_order("label", seq), " | ").alias("translations"))
    if "time_since_last_detection" in flags.columns:
        out.append(F.max("time_since_last_detection").alias("days_since_detected"))
    if "priority_item" in flags.columns:
        out.append(F.bool_or("priority_item").alias("priority_item"))
    rest = [x for x in ("network", "site", "comments", "site_comments") if x in flags.columns]
    if not rest:
        return flags.groupBy(*keys).agg(*out)
    found = flags.groupBy(*keys).agg(*out, F.min_by(F.struct(*rest), seq).alias("_first"))
    return found.select("*", *[F.col(f"_first.{x}").alias(x) for x in rest]).drop("_first")


def bucket() -> Column:
    """O1: open rows first, then resolved ones, then those resolved by hand."""
    return F.when(F.col("manually_resolved") != "", 2).when(F.col("currently_resolved"), 1).otherwise(0)


def classed(rows: DataFrame) -> DataFrame:
    """status_class and the ordering bucket."""
    return rows.withColumn("status_class", v.freshness(F.col("days_since_detected"), F.col("currently_resolved"), F.col("manually_resolved") != "")).withColumn("bucket", bucket())


def fanned_out(rows: DataFrame, raters: DataFrame | None = None) -> DataFrame:
    """A row for each report, and for each rater of the subject if a map (subject, rater) is given."""
    out = of_reports(rows)
    return out if raters is None else out.join(raters, "subject")


def site_backlog(flags: DataFrame, sites: DataFrame, limit: int = 30) -> DataFrame:
    """Open flags by network and site, above and up to a number of days; sites without any keep zeros."""
    open_ = flags.where(~F.col("currently_resolved")).groupBy("network", "site")
    counts = open_.agg(F.count_if(F.col("time_since_last_detection") > limit).alias("older"), F.count_if(F.col("time_since_last_detection") <= limit).alias("newer"))
    return sites.join(counts, ["network", "site"], "left").na.fill(0, ["older", "newer"])


def changes_per_day(changes: DataFrame) -> DataFrame:
    """A9."""
    return changes.groupBy("date").agg(F.count("*").alias("changes"))

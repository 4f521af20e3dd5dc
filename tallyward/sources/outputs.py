"""Writing flags, trackers and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tracker columns as reviewers see them.
DISPLAY = {
    "subject": "Participant", "displayed_timepoint": "Timepoint", "displayed_form": "Form", "flag_count": "Flag Count", "flags": "Flags", "translations": "Translations",
    "days_since_detected": "Days Since Detected", "manually_resolved": "Manually Resolved", "comments": "Network Comments", "site_comments": "Site Comments", "priority_item": "Priority Item",
}


# Columns of reports of all sites.
COMBINED_DISPLAY = {
    "subject": "Participant", "displayed_timepoint": "Timepoint", "displayed_form": "Form", "flag_count": "Flag Count", "flags": "Flags", "days_since_detected": "Days Since Detected",
    "priority_item": "Priority Item", "site": "Site", "network": "Network", "currently_resolved": "Resolved",
}


def inverted(pairs: dict[str, str]) -> dict[str, str]:
    """A lookup the other way round; of equal values the first key stays."""
    return {n: k for k, n in reversed(pairs.items())}


def write_flags(flags: DataFrame, path: str, run_date: str) -> None:
    """One partition for each run and network; a repeated run replaces its own partitions."""
    flags.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "network").parquet(path)


def earlier_flags(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """The flags of the latest earlier run; no rows if there is none."""
    rows = spark.read.parquet(path).where(F.col("run_date") < F.lit(run_date))
    latest = rows.agg(F.max("run_date")).first()[0]
    return rows.where(F.col("run_date") == F.lit(latest) if latest is not None else F.lit(False))


def write_tracker(rows: DataFrame, path: str, display: dict[str, str] = DISPLAY) -> None:
    """Trackers by network, report and site, under reviewers' column names, open rows first."""
    out = rows.orderBy("network", "report", "site", "bucket", "subject", "displayed_timepoint", "displayed_form").withColumnsRenamed({k: n for k, n in display.items() if k in rows.columns and k not in ("network", "site")})
    out.write.mode("overwrite").partitionBy("network", "report", "site").option("header", True).csv(path)


def write_baseline(snapshots: DataFrame, path: str) -> None:
    """The snapshots that the next diff compares with."""
    snapshots.write.mode("overwrite").parquet(path)


def write_records(spark: SparkSession, records: list[dict], schema, path: str) -> None:
    """A short list of records as a table."""
    spark.createDataFrame(records, schema).write.mode("overwrite").parquet(path)

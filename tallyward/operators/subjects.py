"""Subject-level monitors: visit ranges, latest dates, withdrawals, duplicates across subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.values import of_text as cell
from tallyward.operators.gate import may_withdraw
from tallyward.plans.model import TIMEPOINTS, month_of


def visit_ranges(dates: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """A1: the earliest and latest date of each visit."""
    return dates.where(F.col(date).isNotNull()).groupBy(*keys).agg(F.min(date).alias("earliest"), F.max(date).alias("latest"))


def outside_visits(rows: DataFrame, ranges: DataFrame, subject: str, visit: str, ordinal: str, dates: list[str]) -> DataFrame:
    """Rows whose dates all lie before, or after, everything of the current and the previous visit.

    ranges: (subject, visit, ordinal, earliest, latest).  Rows without a range, or whose previous visit has none though there is one before, don't count.
    """
    w = Window.partitionBy(subject).orderBy(ordinal)
    spans = ranges.withColumns({"previous_ordinal": F.lag(ordinal).over(w), "previous_earliest": F.lag("earliest").over(w), "previous_latest": F.lag("latest").over(w)})
    joined = rows.join(spans, [subject, visit])
    complete = (F.col(ordinal) == 0) | (F.col("previous_ordinal") == F.col(ordinal) - 1)
    first = F.least("earliest", "previous_earliest")
    last = F.greatest("latest", "previous_latest")
    outside = [F.coalesce((F.col(d) < first) | (F.col(d) > last), F.lit(False)) for d in dates]
    test = complete
    for o in outside:
        test = test & o
    return joined.where(test)


def latest_dates(dates: DataFrame, subject: str, date: str, form: str) -> DataFrame:
    """Each subject's latest date and the form it is from; ties go to the first form by name."""
    best = F.min(F.struct((-F.unix_date(date)).alias("d"), F.col(form).alias("form")))
    out = dates.where(F.col(date).isNotNull()).groupBy(subject).agg(F.max(date).alias("latest_date"), best.alias("b"))
    return out.select(subject, "latest_date", F.col("b.form").alias("latest_form"))


def excluded_beyond(info: DataFrame, latest: DataFrame, subject: str = "subject", screening=("screening", "screen")) -> DataFrame:
    """Excluded subjects whose visit lies beyond screening, with their latest date."""
    return info.where((F.col("inclusion_status") == "excluded") & ~F.col("visit_status").isin(*screening)).join(latest, subject, "left")


def recent_date(columns: list[str], run_date: Column) -> Column:
    """The latest date, not after the run, among columns, with its column's name."""
    pairs = F.array(*[F.struct(F.col(x).alias("date"), F.lit(x).alias("name")) for x in columns])
    return F.array_max(F.filter(pairs, lambda p: p["date"].isNotNull() & (p["date"] <= run_date)))


def expected_gap(timepoint: str, cohort: str) -> Column:
    """Days to the next visit: 30 for each month between, 30 from screening and baseline; HC go from month2 to month12; none at the end."""
    out = sql.lit(None).cast("int")
    for a, b in zip(TIMEPOINTS, TIMEPOINTS[1:], strict=False):
        days = 30 if a in ("screening", "baseline") else 30 * (month_of(b) - month_of(a))
        out = sql.when(sql.col(timepoint) == a, sql.when(sql.col(cohort) == "HC", 300).otherwise(days) if a == "month2" else days).otherwise(out)
    return F.expr(out.text)


def withdrawals(visits: DataFrame, info: DataFrame, run_date: Column) -> DataFrame:
    """Days until each eligible subject's next visit is due; visits: (subject, timepoint, ordinal, latest)."""
    last = visits.groupBy("subject").agg(F.max_by("timepoint", "ordinal").alias("current_timepoint"), F.max_by("latest", "ordinal").alias("most_recent_date"))
    rows = last.join(info.where(may_withdraw()), "subject")
    return rows.withColumn("days_until_expected_next_visit", expected_gap("current_timepoint", "cohort") - F.datediff(run_date, "most_recent_date"))


def shared_values(long: DataFrame, subject: str, value: str) -> DataFrame:
    """Values that different subjects share, with each subject; repeats within a subject are ignored."""
    pairs = long.where(F.col(value).isNotNull()).select(subject, value).distinct()
    shared = pairs.groupBy(value).agg(F.count("*").alias("subjects")).where("subjects > 1")
    return pairs.join(shared, value)


def vial_key(rack: str, position: str) -> Column:
    """Rack and position as one key, only where both are real values."""
    return F.when(v.filled(rack) & v.filled(position), F.concat_ws("_", rack, position))


def shared_positions(merged: DataFrame, rack: str, positions: list[str], suffixes: tuple[str, ...] = ("_baseln", "_month2"), subject: str = "subjectid") -> DataFrame:
    """Vials of different subjects at one position of one rack, over generations merged side by side (`model.merged_generations`).

    Rack and position are taken from the same generation and count where both are real values.  (value, subject, subjects).
    """
    known = set(merged.columns)
    cells = [f"CASE WHEN {(cell.filled(rack + s) & cell.filled(p + s)).text} THEN concat_ws('_', `{rack}{s}`, `{p}{s}`) END" for s in suffixes for p in positions if rack + s in known and p + s in known]
    long = merged.select(subject, F.expr(f"explode(filter(CAST(array({', '.join(cells)}) AS array<string>), x -> x IS NOT NULL))").alias("value"))
    return shared_values(long, subject, "value").withColumnRenamed(subject, "subject").select("value", "subject", "subjects")

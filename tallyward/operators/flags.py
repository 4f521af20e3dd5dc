"""The flag record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as v
from tallyward.plans.model import site_of

SEPARATOR = " | "


def flag_records(found: DataFrame, run_date: Column, translations: DataFrame | None = None, priority_forms=(), priority_timepoints=("screening",)) -> DataFrame:
    """One record for each violation.

    found: rows of `rules.evaluate` with network, subjectid, timepoint, visit_status_string, removed and inclusion_status.  The flags of removed
    or not included subjects keep no reports, unless a rule enables them (E2: withdrawn_enabled, excluded_enabled).  translations: (variable,
    label) of the dictionary, a row for each variable.
    """
    removed = F.coalesce(F.col("removed") == "True", F.lit(False))
    included = F.coalesce(F.col("inclusion_status") == "included", F.lit(False))
    form = F.get("forms", F.lit(0))
    enabled = lambda x: F.coalesce(F.col(x), F.lit(False)) if x in found.columns else F.lit(False)
    out = found.withColumns({
        "subject": F.col("subjectid"), "site": site_of(), "displayed_form": form, "displayed_timepoint": F.col("timepoint"), "displayed_variable": F.get("variables", F.lit(0)),
        "reports": F.when((included | enabled("excluded_enabled")) & (~removed | enabled("withdrawn_enabled")), F.col("reports")).otherwise(F.array().cast("array<string>")), "withdrawn_status": removed,
        "priority_item": F.coalesce(form.isin(*priority_forms) if priority_forms else F.lit(False), F.lit(False)) | F.col("timepoint").isin(*priority_timepoints),
        "dates_detected": F.array(run_date.cast("date")), "dates_resolved": F.array().cast("array<date>"), "currently_resolved": F.lit(False), "manually_resolved": F.lit(""), "comments": F.lit(""), "site_comments": F.lit(""),
    })
    if translations is None:
        return out.withColumn("var_translations", F.col("variables"))
    labels = F.broadcast(translations.agg(F.map_from_entries(F.collect_list(F.struct("variable", "label"))).alias("labels")))
    named = F.transform("variables", lambda x: F.coalesce(F.element_at("labels", x), x))
    return out.join(labels, how="left").withColumn("var_translations", named).drop("labels")


def piped(x) -> Column:
    """A list as text."""
    return F.array_join(v.c(x), SEPARATOR)


def unpiped(x) -> Column:
    return F.when(v.c(x) == "", F.array().cast("array<string>")).otherwise(F.split(v.c(x), r" \| "))


def report_names(flags: DataFrame) -> DataFrame:
    """The distinct reports."""
    return flags.select(F.explode("reports").alias("report")).distinct()


def for_report(flags: DataFrame, report: str) -> DataFrame:
    """F12."""
    return flags.where(F.array_contains("reports", report))


def of_reports(flags: DataFrame) -> DataFrame:
    """The flags of every report under its name; each name's are those of `for_report`."""
    return flags.withColumn("report", F.explode("reports")).drop("reports")

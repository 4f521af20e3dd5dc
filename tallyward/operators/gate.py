"""Which forms of which rows are due: conditions that come before any rule.

The gate is projected once, as an array of the forms that pass, so that hundreds of rules share it; its conditions are one parsed expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.expressions import Sql, col
from tallyward.functions.values import of_text as cell

KEEPS_OWN_COMPLETION = "PRESCIENT"


@dataclass(frozen=True)
class Form:
    """A form's special variables; `missing_since`: the date from which its missing flag exists, if it was added later."""

    name: str
    completion: str
    missing: str | None = None
    interview_date: str | None = None
    always_shown: tuple[str, ...] = ()
    missing_since: str | None = None


def moved_on() -> Sql:
    """the subject's visit lies after the row's timepoint (never for unordered ones); needs visit_ordinal and ordinal."""
    return sql.coalesce(col("visit_ordinal") > col("ordinal"), False)


def with_ordinals(rows: DataFrame, timepoints: DataFrame) -> DataFrame:
    """Adds ordinal and visit_ordinal from the timepoint dimension."""
    t = timepoints.select("timepoint", "ordinal")
    visit = timepoints.select(F.col("timepoint").alias("_visit"), F.col("ordinal").alias("visit_ordinal"))
    return rows.join(F.broadcast(t), "timepoint", "left").withColumn("_visit", v.timepoint_alias("visit_status_string")).join(F.broadcast(visit), "_visit", "left").drop("_visit")


def introduced(date_variable: str, since: str) -> Sql:
    """the row's interview date lies after the date (yyyy-MM-dd) on which a variable was introduced; a row without a date counts as older."""
    return sql.coalesce(cell.as_date(date_variable, True) > sql.lit(since).cast("date"), False)


def _own() -> Sql:
    return col("network") == KEEPS_OWN_COMPLETION


def marked_missing(form: Form, columns: Iterable[str]) -> Sql:
    """the form is marked missing; without a flag (or before there was one) it is if under half of its always-shown variables are filled."""
    known = set(columns)
    shown = [x for x in form.always_shown if x in known]
    filled = [(col(x).isNotNull() & ~cell.is_blank(x)).cast("int").text for x in shown]
    sparse = sql.expr(f"({' + '.join(filled)}) * 2 < {len(shown)}") if shown else sql.lit(False)
    own = cell.code_in(form.completion + "_rpms", [3, 4]) & _own() if form.completion + "_rpms" in known else sql.lit(False)
    if form.missing is None or form.missing not in known:
        return own | sparse
    flagged = cell.is_code(form.missing, 1)
    if form.missing_since is None or form.interview_date not in known:
        return own | sql.when(col(form.missing).isNull(), sparse).otherwise(flagged)
    since = introduced(form.interview_date, form.missing_since)
    return own | sql.when(~since | col(form.missing).isNull(), sparse).otherwise(flagged)


def extra(form: str) -> Sql:
    """opt-ins and ages that some forms ask for; needs the subject columns age, axivity_opt and mindlamp_opt."""
    tests = {"pubertal_developmental_scale": sql.coalesce(cell.num("age") <= 18, False), "axivity": cell.is_code("axivity_opt", 1), "mindlamp": cell.code_in("mindlamp_opt", [1, 2])}
    return next((t for part, t in tests.items() if part in form), sql.lit(True))


def form_ok(form: Form, columns: Iterable[str], missing: Sql | None = None) -> Sql:
    """complete (or the subject has moved on, where completion is kept apart), not marked missing (`missing`, if that is known already), extra conditions met."""
    known = set(columns)
    names = [x for x in (form.completion, v.network_completion(form.completion)) if x in known]
    if not names:
        return sql.lit(False)
    complete = cell.is_code(names[0], 2)
    if len(names) == 2:
        complete = sql.when(_own(), cell.is_code(names[1], 2)).otherwise(complete)
    complete = complete | (_own() & moved_on())
    return complete & ~(marked_missing(form, known) if missing is None else missing) & extra(form.name)


def gated(rows: DataFrame, forms: Iterable[Form], due: DataFrame) -> tuple[DataFrame, Callable[[str], Sql]]:
    """rows with a column _ok of the forms that pass, and the gate over it; due: (cohort, timepoint, forms array)."""
    forms, columns = list(forms), rows.columns
    passing = "array_intersect(CAST(array({}) AS array<string>), coalesce(forms, CAST(array() AS array<string>)))"  # nulls are no due forms
    made = ", ".join(f"CASE WHEN {form_ok(f, columns).text} THEN {sql.text_of(f.name)} END" for f in forms)
    # due has a row for each cohort and timepoint, a few dozen
    known = rows.where(F.lower("cohort").isin("hc", "chr")).join(F.broadcast(due.withColumn("forms", F.array_compact("forms"))), ["cohort", "timepoint"], "left")
    return known.withColumn("_ok", F.expr(passing.format(made))).drop("forms"), lambda form: sql.array_contains(col("_ok"), form)


def skips_modules(variable: str, form_b: Iterable[str], form_c: Iterable[str]) -> Sql:
    """variables of two diagnosis modules are skipped where the module's entry questions are blank or missing."""
    if variable not in form_b and variable not in form_c:
        return sql.lit(False)
    return _own() & (cell.is_empty("chrscid_b1") | cell.is_empty("chrscid_b16"))


def may_withdraw() -> Column:
    """F8: known cohort, included, neither screen failure nor completed."""
    return F.col("cohort").isin("HC", "CHR") & (F.col("inclusion_status") == "included") & ~F.coalesce("screenfail", F.lit(False)) & ~F.coalesce("completed_study", F.lit(False))


def completion_checks(rows: DataFrame, due: DataFrame, completions: DataFrame) -> DataFrame:
    """Forms of a cohort and timepoint that aren't complete although the subject has moved on.

    completions: (subjectid, timepoint, form, status); rows: (subjectid, network, cohort, timepoint, ordinal, visit_ordinal).
    """
    pairs = rows.where(moved_on().text).join(F.broadcast(due.select("cohort", "timepoint", F.explode("forms").alias("form"))), ["cohort", "timepoint"])
    return open_forms(pairs.join(completions, ["subjectid", "timepoint", "form"]))


def open_forms(cells: DataFrame) -> DataFrame:
    """What is due and not complete, with its message and reports; cells: (network, form, status, ...) of subjects that have moved on."""
    own = F.col("network") == KEEPS_OWN_COMPLETION
    reports = F.when(own, F.array(F.lit("Main Report"), F.lit("Incomplete Forms"))).otherwise(F.array(F.lit("Incomplete Forms")))
    kept = cells.where(~v.code_in("status", [2, 3, 4]) & ~F.col("form").contains("gcp") & ~(own & (F.col("form") == "informed_consent_run_sheet")))
    return kept.withColumn("error_message", F.lit("Form is not marked as complete, but the subject has moved on.")).withColumn("reports", reports)

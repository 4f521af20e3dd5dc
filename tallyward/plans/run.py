"""A whole run: snapshot rows and a dictionary become flags, flags pass through their life, and trackers are made of them.

The driver holds only what the dictionary gives (a few entries for each variable and form); rows stay in Spark from the snapshots to the
trackers.  A run reads its rows once: `prepared` writes them with their subjects' fields and the forms that pass the gate, by network, and all checks
read that table.  Rules are compiled once, for all networks, to a few expressions (`rules.evaluate`); cells that a single-variable check may
flag are found by one expression and written too.  Flags go once to the tasks of their visits' forms, where their life is worked out, and that is written before trackers are made of it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.expressions import Sql, col
from tallyward.functions.values import of_text as cell
from tallyward.operators import catalog, crosschecks, gate, lifecycle, rules, subjects, tracker
from tallyward.operators.flags import flag_records
from tallyward.plans import content, model
from tallyward.plans import dictionary as dd
from tallyward.sources.stages import written

#: What a flag keeps of its row.
KEYS = ["network", "subjectid", "timepoint", "visit_status_string", "removed", "inclusion_status"]


@dataclass(frozen=True)
class Study:
    """What the dictionary says: tables of a row for each variable or form, and what the driver needs to build rules."""

    blank: DataFrame
    missing_codes: DataFrame
    specific: DataFrame
    ranges: DataFrame
    teams: DataFrame
    labels: DataFrame
    forms: list[gate.Form]
    form_of: dict[str, str]
    excluded: dict[str, frozenset[str]]
    compiled: dict[str, str | None]
    checked: dict[str, frozenset[str]] = field(default_factory=dict)
    groups: dict[str, set[str]] = field(default_factory=dict)
    interview_dates: dict[str, str] = field(default_factory=dict)
    users: dict[str, str] = field(default_factory=dict)
    reasons: dict[str, tuple[str, str]] = field(default_factory=dict)


def _sets(pairs: list[dict], key: str) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for r in pairs:
        out.setdefault(r[key], set()).add(r["variable"])
    return out


def _collected(tables: dict[str, DataFrame]) -> dict[str, list[dict]]:
    """The rows of tables of the dictionary's size, in one job."""
    out: dict[str, list[dict]] = {name: [] for name in tables}
    rows = [t.select(F.lit(name).alias("name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")) for name, t in tables.items()]
    for r in reduce(DataFrame.unionByName, rows).collect():
        out[r["name"]].append(json.loads(r["row"]))
    return out


def study(dictionary: DataFrame, added: DataFrame | None = None) -> Study:
    """The metadata of a dictionary; added: (variable) of variables that an older dictionary doesn't have."""
    spark = dictionary.sparkSession
    dictionary = spark.createDataFrame(dictionary.toArrow())  # rows of the driver, so that no plan reads the dictionary again
    kept = {
        "blank": content.blank_checks(dictionary), "missing_codes": content.missing_code_checks(dictionary), "specific": content.specific_values(dictionary),
        "ranges": dd.ranges(dictionary).join(dictionary.select("variable", "form"), "variable"), "teams": content.teams(dictionary), "labels": dd.labels(dictionary),
    }
    others = {
        "meta": content.metadata(dictionary), "forms": dd.forms_of(dictionary), "excluded": content.excluded(dictionary, added), "groups": content.blood_groups(dictionary).unionByName(content.module_groups(dictionary)),
        "compiled": content.predicate_rows(dictionary), "unsupported": dd.unsupported(dictionary).select("variable"),
    }
    found = _collected(kept | others)
    tables = {name: spark.createDataFrame([tuple(r.get(c) for c in t.columns) for r in found[name]], t.schema).coalesce(1) for name, t in kept.items()}
    meta = found["meta"]
    return Study(
        **tables, forms=content.forms(meta), form_of={r["variable"]: r["form"] for r in found["forms"]}, excluded={n: frozenset(x) for n, x in _sets(found["excluded"], "network").items()},
        compiled=content.usable_predicates(found["compiled"], found["unsupported"]), checked={name: frozenset(r["variable"] for r in found[name]) for name in ("blank", "missing_codes", "specific", "ranges")},
        groups=_sets(found["groups"], "grp"), interview_dates={r["form"]: r["interview_date_var"] for r in meta if r.get("interview_date_var")},
        users={r["form"]: r["redcap_user_var"] for r in meta if r.get("redcap_user_var")}, reasons={r["form"]: (r["missing_var"], r["missing_spec_var"]) for r in meta if r.get("missing_var") and r.get("missing_spec_var")},
    )


def listed_rules(of: Study, columns: list[str], run_date: Sql, diagnoses: dict[str, dict] | None = None, scid: bool = True) -> list[rules.Rule]:
    """All rules of the catalogue for rows with these columns."""
    out = catalog.general_rules()
    out += catalog.blood_rules(tuple(sorted(of.groups.get("volume", ()))), tuple(sorted(of.groups.get("barcode", ()))), run_date)
    out += catalog.clinical_rules() + catalog.medication_rules(columns) + catalog.latest_onset(columns) + catalog.unknown_names(columns)
    out += [catalog.missing_reason(flag, reason, form) for form, (flag, reason) in of.reasons.items()]
    out += [r for _, reason in of.reasons.values() if "psychs" in reason for r in catalog.within_21_days(of.interview_dates, reason)]
    return out + (catalog.scid_rules(diagnoses) if scid else [])


def with_subjects(rows: DataFrame, info: DataFrame, timepoints: DataFrame) -> DataFrame:
    """Rows of known subjects with their fields; info: a row for each subject (`model.subject_info`)."""
    own = info.select(F.col("subject").alias("subjectid"), *[x for x in info.columns if x != "subject" and x not in rows.columns])
    removed = rows.join(own, "subjectid").withColumn("removed", F.when(F.col("visit_status_string") == "removed", "True").otherwise("False"))
    return gate.with_ordinals(removed, timepoints)


def _flag(found: DataFrame, rule: str, seq: int, form: Column, variable: Column, reports: Column, prefix: bool = True) -> DataFrame:
    message = F.concat(variable, F.lit(" : "), "error_message") if prefix else F.col("error_message")
    return found.select(
        *KEYS, F.lit(seq).alias("seq"), F.lit(rule).alias("rule"), F.array(form).alias("forms"), F.array(variable).alias("variables"), message.alias("error_message"),
        reports.cast("array<string>").alias("reports"), F.lit(False).alias("withdrawn_enabled"), F.lit(False).alias("excluded_enabled"),
    )


def prepared(rows: DataFrame, of: Study, due: DataFrame, run_date: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of `with_subjects`, written once by network with the forms that pass the gate (_ok) and those that aren't marked missing (_there); and those of them that rules judge (known cohorts)."""
    due = due.select(F.lower("cohort").alias("_cohort"), "timepoint", F.array_compact("forms").alias("forms"))
    columns = rows.columns
    # forms that don't pass are nulls of the array, which no due form is, so that no lambda has to drop them (its argument would be interpreted)
    listed = lambda tests: f"CAST(array({', '.join(f'CASE WHEN {test.text} THEN {sql.text_of(f.name)} END' for f, test in zip(of.forms, tests))}) AS array<string>)"
    marks = [Sql(f"get(_missing, {i})") for i in range(len(of.forms))]
    missing = f"CAST(array({', '.join(f'coalesce({gate.marked_missing(f, columns).text}, false)' for f in of.forms)}) AS array<boolean>)"
    ok, gone = listed([gate.form_ok(f, columns, mark) for f, mark in zip(of.forms, marks)]), listed(marks)
    known = rows.withColumn("_cohort", F.lower("cohort")).join(F.broadcast(due), ["_cohort", "timepoint"], "left").drop("_cohort").withColumn("_due", F.expr("coalesce(forms, CAST(array() AS array<string>))")).drop("forms")
    out = known.withColumn("_missing", F.expr(missing)).withColumns({"_ok": F.expr(f"array_intersect({ok}, _due)"), "_there": F.expr(f"array_except(_due, {gone})"), "_run_date": run_date.cast("date")}).drop("_missing")
    out = written(out, "rows", "network")
    return out, out.where(F.lower("cohort").isin("hc", "chr"))


def single_checks(rows: DataFrame, of: Study, passes) -> DataFrame:
    """R1, R2 (where the variable applies and its module isn't skipped), R3 and R6; the joined tables have a row for each variable and report."""
    every = frozenset().union(*of.checked.values())
    applies, skipped = content.applies(of.compiled, rows.columns), content.skipped(of.groups)
    judged = lambda x: rules.all_of([applies(x), ~skipped(x)])
    suspect = lambda x: x.judged & ((x.value == "") | v.is_missing(x.value) | (x.value == "NaN"))
    forms = {x: of.form_of[x] for x in sorted(every) if x in of.form_of}
    cells = written(rules.marked_cells(rows, KEYS, forms, judged, passes, of.excluded, suspect, of.checked["specific"] | of.checked["ranges"]), "cells")
    main, own = F.array(F.lit("Main Report")), cells.where("judged").drop("judged", "form")
    # a network without a list of its own has no missing codes to look for
    out = [
        content.with_teams(_flag(rules.blank_checks(own, F.broadcast(of.blank)), "blank", 0, F.col("form"), F.col("variable"), F.array("report")), of.teams),
        content.with_teams(_flag(rules.missing_code_checks(cells.where("judged"), F.broadcast(of.missing_codes), ["network", "variable"]), "missing code", 1, F.col("form"), F.col("variable"), main), of.teams),
        _flag(rules.specific_value_checks(cells.drop("form"), F.broadcast(of.specific)), "specific value", 2, F.col("form"), F.col("variable"), F.col("reports")),
        _flag(rules.range_checks(cells.drop("form"), F.broadcast(of.ranges)), "range", 3, F.col("form"), F.col("variable"), main),
    ]
    return reduce(DataFrame.unionByName, out)


def completion_flags(rows: DataFrame, of: Study) -> DataFrame:
    """R4 over the completion columns that the rows have; rows with _due."""
    known, cells = set(rows.columns), []
    own = col("network") == gate.KEEPS_OWN_COMPLETION
    for f in of.forms:
        names = [x if x in known else None for x in (f.completion, v.network_completion(f.completion))]
        if any(names):
            value = lambda x: col(x).cast("string") if x else sql.lit(None).cast("string")
            status, name = sql.when(own, value(names[1])).otherwise(value(names[0])), sql.when(own, v.network_completion(f.completion)).otherwise(f.completion)
            cells.append(f"struct({sql.text_of(f.name)} AS form, {status.text} AS status, {name.text} AS variable)")
    if not cells:
        return rows.where("false").select(*KEYS, F.lit("").alias("form"), F.lit("").alias("variable"), F.lit("").alias("error_message"), F.array().cast("array<string>").alias("reports"))
    late = rows.where(gate.moved_on().text).select(*KEYS, F.expr(f"inline(filter(array({', '.join(cells)}), x -> x.status IS NOT NULL AND array_contains(_due, x.form)))"))
    return gate.open_forms(late)


def form_dates(rows: DataFrame, of: Study) -> DataFrame:
    """A1: (subjectid, timepoint, ordinal, form, date) of the interview dates of due forms that aren't marked missing; one unpivot feeds ranges, the range check and the monitor."""
    cells = [f"CASE WHEN array_contains(_there, {sql.text_of(f)}) THEN named_struct('form', {sql.text_of(f)}, 'date', {cell.real_date(x, True).text}) END" for f, x in of.interview_dates.items() if x in rows.columns]
    keys = ["subjectid", "timepoint", "ordinal"]
    if not cells:
        return rows.where("false").select(*keys, F.lit("").alias("form"), F.lit(None).cast("date").alias("date"))
    return rows.select(*keys, F.expr(f"inline(filter(array({', '.join(cells)}), x -> x.date IS NOT NULL))"))


def withdrawn(rows: DataFrame, visits: DataFrame, run_date: Column) -> DataFrame:
    """The withdrawn table, a row for each eligible subject: the days until the next visit after the last one with a date.

    Screen failures and completed studies are known of one network only.  rows and visits as in `flags`.
    """
    ended = lambda x: F.bool_or(F.col(x) & (F.col("network") != gate.KEEPS_OWN_COMPLETION)) if x in rows.columns else F.lit(False)
    first = [F.first(x, ignorenulls=True).alias(x) for x in ("network", "cohort", "inclusion_status")]
    info = rows.groupBy(F.col("subjectid").alias("subject")).agg(*first, ended("screenfail").alias("screenfail"), ended("completed_study").alias("completed_study"), F.bool_or(F.col("removed") == "True").alias("withdrawn_status"))
    ordered = visits.where("ordinal is not null").withColumnRenamed("subjectid", "subject")
    columns = ["subject", "network", "cohort", "current_timepoint", "most_recent_date", "days_until_expected_next_visit", "withdrawn_status"]
    return subjects.withdrawals(ordered, info, run_date).where("days_until_expected_next_visit is not null").select(*columns)


@dataclass(frozen=True)
class Found:
    """What the checks of a run give: flags, the withdrawn table, and the visits' date ranges."""

    flags: DataFrame
    withdrawn: DataFrame
    visits: DataFrame


def checked(rows: DataFrame, of: Study, due: DataFrame, run_date: Column, conversions: DataFrame | None = None, diagnoses: dict[str, dict] | None = None) -> Found:
    """All checks of a run.

    rows: `with_subjects`; due: (cohort, timepoint, forms); conversions: (subject, conversion_date) of `snapshots.read_conversions` for R51;
    diagnoses: as `catalog.scid_rules` takes them, for R39.
    """
    every, passing = prepared(rows, of, due, run_date)
    columns = rows.columns
    passes = lambda form: sql.array_contains(col("_ok"), form)
    listed = listed_rules(of, columns, col("_run_date"), diagnoses)
    out = [rules.evaluate(passing, listed, KEYS, passes, content.applies(of.compiled, columns), of.excluded).withColumn("seq", F.col("seq") + 100), single_checks(passing, of, passes)]
    form, no = F.lit(catalog.CURRENT_MEDICATION[0]), F.array(F.lit("Main Report"))
    out.append(_flag(completion_flags(every, of), "completion", 4, F.col("form"), F.col("variable"), F.col("reports")))
    names = _names(columns)
    if names:
        slots = rules.slots(every, KEYS, max(n for n, _ in names), {"name": "chrpharm_med{n}_name"})
        twice = rules.repeated_in_slots(slots, KEYS, "name")
        twice = twice.withColumn("error_message", F.concat(F.lit("The name "), "name", F.lit(" is in slots "), "slot_1", F.lit(" and "), "slot_2"))
        out.append(_flag(twice, "repeated name", 5, form, _slot_name("slot_1"), no))
        both = catalog.overlapping_medications(every, KEYS)
        both = both.withColumn("error_message", F.concat(F.lit("The name "), "name", F.lit(" has overlapping dates in slots "), "slot_1", F.lit(" and "), "slot_2"))
        out.append(_flag(both, "overlapping medication", 6, form, _slot_name("slot_1"), no))
    visits = written(subjects.visit_ranges(form_dates(passing, of), ["subjectid", "timepoint", "ordinal"]), "visits")
    changed = [x for x in ("chrpharm_date_mod", "chrpharm_date_mod_2") if x in columns]
    if changed:
        days = passing.where("ordinal is not null").select(*KEYS, *[v.real_date(x, True).alias(x) for x in changed])
        late = subjects.outside_visits(days.where(" AND ".join(f"{x} IS NOT NULL" for x in changed)), visits.where("ordinal is not null"), "subjectid", "timepoint", "ordinal", changed)
        late = late.withColumn("error_message", F.concat(F.lit("Modified on "), F.concat_ws(" and ", *[F.col(x).cast("string") for x in changed]), F.lit(", outside of this and the previous visit")))
        out.append(_flag(late, "modification date", 7, form, F.lit(changed[0]), no))
    if conversions is not None and "chrconv_interview_date" in columns:
        out.append(_flag(crosschecks.unrecorded_conversions(every, conversions), "conversion date", 8, F.lit("conversion_form"), F.lit("chrconv_interview_date"), no))
    wide = crosschecks.parents(every, KEYS)
    if wide is not None:
        out.append(rules.evaluate(wide, crosschecks.differing_ages(), KEYS, passes).withColumn("seq", F.col("seq") + 10_000))
    records = flag_records(reduce(DataFrame.unionByName, out), run_date, of.labels)
    return Found(records, withdrawn(every, visits, run_date), visits)


def flags(rows: DataFrame, of: Study, due: DataFrame, run_date: Column, **more) -> DataFrame:
    """The flag records of a run."""
    return checked(rows, of, due, run_date, **more).flags


def _names(columns: list[str]) -> list[tuple[int, str]]:
    return [(n, f"chrpharm_med{n}_name") for n, past in catalog.medication_slots(columns) if not past and n > 0]


def _slot_name(slot: str) -> Column:
    return F.concat(F.lit("chrpharm_med"), F.col(slot).cast("string"), F.lit("_name"))


def trackers(life: DataFrame, raters: DataFrame | None = None) -> DataFrame:
    """One row for each report and form of a visit (and rater, if a map (subject, rater) is given), classed and numbered for ordering."""
    by = ("report", "rater", *tracker.GROUP) if raters is not None else ("report", *tracker.GROUP)
    return tracker.classed(tracker.merged(tracker.fanned_out(life, raters), keys=by))


@dataclass(frozen=True)
class Outcome:
    """A run's tables: flags after it, trackers by report (and by rater), the withdrawn table."""

    flags: DataFrame
    trackers: DataFrame
    withdrawn: DataFrame
    by_rater: DataFrame | None = None


def run(rows: DataFrame, of: Study, due: DataFrame, run_date: Column, old: DataFrame | None = None, sheet: DataFrame | None = None, raters: DataFrame | None = None, **more) -> Outcome:
    """A run and its trackers: old are the flags of the run before, sheet the reviewers' comments, raters a map (subject, rater)."""
    found = checked(rows, of, due, run_date, **more)
    new = found.flags  # read once, on the way to their keys' tasks
    life = lifecycle.step(old if old is not None else new.where("false"), new, run_date)
    life = written(lifecycle.reviewed(life, sheet) if sheet is not None else life, "life")
    return Outcome(life, trackers(life), found.withdrawn, trackers(life, raters) if raters is not None else None)

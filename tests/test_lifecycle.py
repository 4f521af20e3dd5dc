import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tallyward.operators import discovery, lifecycle, tracker

KEY = ("subject", "form")
SCHEMA = "subject string, form string, dates_detected array<date>, dates_resolved array<date>, currently_resolved boolean, manually_resolved string, comments string, site_comments string"


def fold(runs):
    """The life of flags, one run after another."""
    state = {}
    for day, present in runs:
        for k in present - state.keys():
            state[k] = ([day], [], False)
        for k, (detected, resolved, done) in list(state.items()):
            if k in present and done:
                state[k] = ([*detected, day], resolved, False)
            elif k not in present and not done:
                state[k] = (detected, [*resolved, day], True)
    return state


def new_flags(spark, day, present):
    return spark.createDataFrame([(k, "f", [day], [], False, "", "", "") for k in present], SCHEMA)


def test_steps_equal_a_fold_over_runs(spark):
    rng = random.Random(5)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(5)]
    runs = [(d, {f"s{i}" for i in range(12) if rng.random() < 0.5}) for d in days]
    state = new_flags(spark, days[0], runs[0][1])
    for day, present in runs[1:]:
        out = lifecycle.step(state, new_flags(spark, day, present), F.lit(str(day)), keys=KEY)
        state = spark.createDataFrame([tuple(r[c] for c in ("subject", "form", "dates_detected", "dates_resolved", "currently_resolved", "manually_resolved", "comments", "site_comments")) for r in out.collect()], SCHEMA)
    assert {r["subject"]: (r["dates_detected"], r["dates_resolved"], r["currently_resolved"]) for r in state.collect()} == fold(runs)
    grid = spark.createDataFrame([(k, d) for d, p in runs for k in p], "k string, d date")
    stretches = lifecycle.history(spark.createDataFrame([(d,) for d in days], "d date"), grid, "k", "d").collect()
    expected = {(k, d) for k, (detected, _, _) in fold(runs).items() for d in detected}
    assert {(r["k"], r["detected"]) for r in stretches} == expected


def test_reviews(spark):
    flags = spark.createDataFrame([("a", "t", "f", "m1"), ("a", "t", "f", "m2"), ("b", "t", "f", "m1")], "subject string, displayed_timepoint string, displayed_form string, error_message string")
    flags = flags.withColumns({"manually_resolved": F.lit(""), "comments": F.lit("old"), "site_comments": F.lit("")})
    sheet = spark.createDataFrame([("a", "t", "f", "m1 | m3", "", "seen", "")], "subject string, displayed_timepoint string, displayed_form string, flags string, manually_resolved string, comments string, site_comments string")
    got = {(r["subject"], r["error_message"]): r["comments"] for r in lifecycle.reviewed(flags, sheet).collect()}
    assert got == {("a", "m1"): "seen", ("a", "m2"): "", ("b", "m1"): "old"}


def test_trackers_merge_in_order_without_repeats(spark):
    rows = [("a", 3, "m3", 5, False), ("a", 1, "m1", 9, True), ("a", 2, "m3", 1, False), ("b", 1, "x", None, False)]
    flags = spark.createDataFrame(rows, "subject string, seq int, error_message string, time_since_last_detection int, priority_item boolean")
    got = {r["subject"]: r for r in tracker.merged(flags, keys=("subject",)).collect()}
    assert (got["a"]["flags"], got["a"]["flag_count"], got["a"]["days_since_detected"], got["a"]["priority_item"]) == ("m1 | m3", 2, 9, True)
    assert got["b"]["flag_count"] == 1


def test_rater_scores_equal_a_fold(spark):
    rng = random.Random(3)
    rows = [(f"r{rng.randrange(3)}", f"s{rng.randrange(4)}", f"f{rng.randrange(2)}", f"v{rng.randrange(3)}", i, rng.expovariate(0.8) + 0.01) for i in range(400)]
    forms, first, variables, totals = {}, set(), {}, {}
    for rater, subject, form, variable, _, z in rows:
        part = z**0.75 * forms.get((rater, subject, form), 1.0) * variables.get((rater, variable), 1.0)
        total = totals.setdefault(rater, [0.0, 0])
        total[0], total[1] = total[0] + part, total[1] + 1
        if z > 2:
            forms[rater, subject, form] = forms.get((rater, subject, form), 1.0) / 2
            if (rater, subject, variable) not in first:
                first.add((rater, subject, variable))
                variables[rater, variable] = variables.get((rater, variable), 1.0) * z**0.25
    scored = spark.createDataFrame(rows, "rater string, subject string, form string, variable string, i int, z double")
    got = {r["rater"]: r["score"] for r in discovery.rater_scores(scored, "rater", "subject", "form", "variable", "z", ["i"]).collect()}
    assert all(abs(got[k] - a / n) < 1e-9 for k, (a, n) in totals.items()) and len(got) == len(totals)

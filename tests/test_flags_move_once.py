"""A run's flags go from their checks to their tasks once, and what decides about a row is compiled, not interpreted in a lambda."""

from pyspark.sql import functions as F

from tallyward.functions.expressions import col
from tallyward.functions import expressions as sql
from tallyward.operators import catalog, lifecycle, rules
from tallyward.plans import catalog_queries, model, run

DAY = "2024-05-01"


def test_new_flags_are_moved_and_sorted_once(spark):
    names = [f"CAST(id % 9 AS STRING) AS {x}" for x in lifecycle.KEYS]
    new = spark.range(20).selectExpr(*names, "CAST(id % 2 AS INT) AS seq", "array(DATE'2024-05-01') AS dates_detected", "array(DATE'2024-05-01') AS dates_resolved", "false AS currently_resolved")
    life = lifecycle.step(new.where("false"), new, F.lit(DAY))
    plan = life._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange"), plan.count("Sort [")) == (1, 1), plan
    assert sorted((r["subject"], r["seq"]) for r in life.collect()) == [(str(i), 0) for i in range(9)]


def test_a_run_writes_flags_with_their_life_only(spark, monkeypatch):
    names, written = [], run.written
    monkeypatch.setattr(run, "written", lambda df, name, *by: names.append(name) or written(df, name, *by))
    run.run(*_small(spark), F.lit(DAY).cast("date"))
    assert sorted(names) == ["cells", "life", "rows", "visits"]


def _small(spark, forms=None):
    cells = {"chrblood_vol1": "1.5", "chrblood_bc1": "1234567890", "chrap_x": "-9", "chroasis_oasis_1": "0", "chroasis_oasis_2": "2", "chrscid_b1": "", "chrscid_b16": "1", "chrspeech_upload": "1"}
    columns = {"subjectid": "S1", "network": "PRONET", "timepoint": "baseline", "visit_status_string": "month1"} | {f"{f}_complete": "2" for f in catalog_queries.STUDY_FORMS} | cells
    rows = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    info = spark.createDataFrame([("S1", "included", "CHR", "20")], "subject string, inclusion_status string, cohort string, age string")
    due = spark.createDataFrame([("CHR", "baseline", [*catalog_queries.STUDY_FORMS] if forms is None else forms)], "cohort string, timepoint string, forms array<string>")
    return run.with_subjects(rows, info, model.timepoints(spark)), catalog_queries.study_of(spark), due


def test_a_null_among_due_forms_changes_nothing(spark):
    found = [{(r["rule"], r["displayed_variable"]) for r in run.flags(*_small(spark, forms), F.lit(DAY).cast("date")).collect()} for forms in (None, [None, *catalog_queries.STUDY_FORMS])]
    assert found[0] == found[1] and {rule for rule, _ in found[0]} == {"volume chrblood_vol1", "missing code", "anxiety 2", "blank"}


def test_a_lambda_holds_no_tests_of_cells(spark):
    listed = rules.usable(catalog.clinical_rules(), catalog_queries.clinical_names())
    gate = lambda form: sql.array_contains(col("_ok"), form)
    for made, tests in rules.compiled(listed, gate, None, frozenset()):
        assert "_ok" not in made and any("_ok" in t for t in tests) and len(tests) <= rules.CHUNK
    cells = spark.createDataFrame([("a", "7", ["f"]), ("b", "-9", ["f"]), ("c", "-9", [])], "k string, x string, _ok array<string>")
    marked = rules.marked_cells(cells, ["k"], {"x": "f"}, lambda x: sql.lit(True), gate, frozenset(), lambda x: x.value == "-9")
    assert [tuple(r) for r in marked.collect()] == [("b", "x", "f", "-9", True)]
    generate = next(x for x in marked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in x)
    assert "_ok" not in generate and "-9" not in generate

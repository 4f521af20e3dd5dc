"""A whole run on a small study, and the contract of the entry."""

import subprocess
import sys

from pyspark.sql import functions as F

from tallyward.operators import catalog
from tallyward.plans import catalog_queries, content, model, run
from tallyward.sources import outputs, snapshots


def test_entry_can_be_imported_without_a_session():
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=run.__file__.rsplit("/", 3)[0]).stdout) > 50


def test_catalogue_names_are_those_of_its_rules(spark):
    names = lambda made: {x for r in made for x in r.variables}
    assert catalog_queries.clinical_names() == names(catalog.clinical_rules())
    assert catalog_queries.SCID_NAMES == names(catalog.scid_rules(catalog_queries.DIAGNOSES))


def small(spark, **cells):
    columns = {"subjectid": "S1", "network": "PRONET", "timepoint": "baseline", "visit_status_string": "month1"} | {f"{f}_complete": "2" for f in (*catalog_queries.STUDY_FORMS, "guid_form")} | cells
    rows = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    info = spark.createDataFrame([("S1", "included", "CHR", "20"), ("S2", "included", "CHR", "20")], "subject string, inclusion_status string, cohort string, age string")
    due = spark.createDataFrame([("CHR", "baseline", [*catalog_queries.STUDY_FORMS, "guid_form"])], "cohort string, timepoint string, forms array<string>")
    return run.with_subjects(rows, info, model.timepoints(spark)), due


def test_a_run_and_the_next_one(spark):
    of = catalog_queries.study_of(spark)
    day = lambda x: F.lit(x).cast("date")
    rows, due = small(spark, chrblood_vol1="1.5", chrblood_bc1="1234567890", chrap_x="-9", chroasis_oasis_1="0", chroasis_oasis_2="2", chrscid_b1="", chrscid_b16="1", chrspeech_upload="1")
    first = run.run(rows, of, due, day("2024-05-01")).flags
    # chrscid_b16 is filled, so half of that form is
    assert {r["rule"] for r in first.collect()} == {"volume chrblood_vol1", "missing code", "anxiety 2", "blank"}
    by_rule = {r["rule"]: r for r in first.collect()}
    assert by_rule["blank"]["reports"] == ["Main Report", "Non Team Forms", "Scid Report"] and by_rule["anxiety 2"]["reports"] == ["Secondary Report"]
    kept = spark.createDataFrame(first.collect(), first.schema)
    rows, due = small(spark, chrblood_vol1="1", chrblood_bc1="1234567890", chrap_x="1", chroasis_oasis_1="0", chroasis_oasis_2="2", chrscid_b1="1", chrscid_b16="1", chrspeech_upload="1")
    second = run.run(rows, of, due, day("2024-05-09"), old=kept)
    second, trackers = second.flags, second.trackers
    state = {r["rule"]: (r["currently_resolved"], [str(d) for d in r["dates_resolved"]], r["time_since_last_detection"]) for r in second.collect()}
    assert state["anxiety 2"] == (False, [], 8) and state["blank"] == (True, ["2024-05-09"], 8)
    assert {(r["report"], r["currently_resolved"], r["status_class"]) for r in trackers.collect()} >= {("Secondary Report", False, "orange"), ("Main Report", True, "green")}


def test_removed_and_excluded_subjects_keep_enabled_reports(spark):
    of = catalog_queries.study_of(spark, (("chrguid_guid", "guid_form", "text", "GUID", "", "", "", ""),))
    rows, due = small(spark, chrguid_guid="BAD", chrap_x="-9")
    removed = rows.withColumns({"removed": F.lit("True"), "visit_status_string": F.lit("removed")})
    found = {r["rule"]: r["reports"] for r in run.flags(removed, of, due, F.lit("2024-05-01").cast("date")).collect()}
    assert found["identifier chrguid_guid"] == ["Main Report", "Non Team Forms"] and found["missing code"] == []


def test_forms_whose_missing_flag_came_later(spark):
    d = [("chrscid_missing", content.SCID, "checkbox", "", f"1, {content.MISSING_TEXT}", "", "", "", "", "", ""), ("chrscid_interview_date", content.SCID, "text", "Interview date", "", "", "", "", "", "", "")]
    names = ("variable", "form", "field_type", "label", "choices", "branching_logic", "required", "identifier", "validation", "validation_min", "validation_max")
    (form,) = run.study(spark.createDataFrame(d, ", ".join(f"{x} string" for x in names))).forms
    assert (form.missing, form.interview_date, form.missing_since, form.always_shown) == ("chrscid_missing", "chrscid_interview_date", "2024-12-25", ("chrscid_interview_date",))


def test_files(spark, tmp_path):
    for name, text in {"combined-PRONET-baseline-day1to1.csv": "subjectid,a\nS1,x\n", "combined-PRONET-month1-day1to1.csv": "subjectid,a\nS2,y\n", "combined-PRESCIENT-month1-day1to1.csv": 'subjectid,"b"\nS3,"z\nw"\n'}.items():
        (tmp_path / name).write_text(text)
    paths = [str(p) for p in sorted(tmp_path.glob("*.csv"))]
    assert sorted(len(x) for x in snapshots.headers(spark, paths).values()) == [1, 2]
    assert {(r["subjectid"], r["timepoint"], r["a"], r["b"]) for r in snapshots.read_snapshots(spark, paths).collect()} == {("S1", "baseline", "x", None), ("S2", "month1", "y", None), ("S3", "month1", None, "z\nw")}
    assert snapshots.newest(["/x/d_2023-05-19.csv", "/x/d_2024-01-02.csv", "/x/z.csv"]) == "/x/d_2024-01-02.csv"
    snapshots.write_metadata(spark.createDataFrame([("a", 1)], "k string, n int"), str(tmp_path / "m"))
    assert snapshots.read_metadata(spark, str(tmp_path / "m"), "k string, n int").collect() == [("a", 1)]
    assert outputs.inverted({"a": "x", "b": "y", "c": "x"}) == {"x": "a", "y": "b"}


def test_medication_slots_that_overlap(spark):
    names = ["k", *(f"chrpharm_{x}" for x in ("med1_name", "med1_onset", "lastuse_med1", "med1_use", "med2_name", "med2_onset", "lastuse_med2", "med2_use"))]
    rows = [("a", "5", "2024-01-01", "2024-01-09", "1", "5", "2024-01-09", "2024-02-01", "1"), ("b", "5", "2024-01-01", "2024-01-09", "1", "5", "2024-01-05", "2024-02-01", "2.0"), ("c", "5", "2024-01-01", "2024-01-08", "", "5", "2024-01-09", "2024-02-01", ""), (None, "5", "2024-01-01", "2024-01-09", "", "5", "2024-01-05", "2024-02-01", "2")]
    found = catalog.overlapping_medications(spark.createDataFrame(rows, ", ".join(f"{x} string" for x in names)), ["k"]).collect()
    assert {tuple(r) for r in found} == {("a", "5", 1, 2), (None, "5", 1, 2)}

from tallyward.operators import diffs
from tallyward.plans import dictionary as dd
from tallyward.sources import outputs, snapshots


def test_snapshots_keep_absent_columns_apart_from_blanks(spark, tmp_path):
    (tmp_path / "combined-PRONET-baseline-day1to1.csv").write_text("subjectid,a\nAB1,\nAB2,NA\n")
    (tmp_path / "combined-PRESCIENT-month1-day1to1.csv").write_text("subjectid,b\nCD1,5\n")
    rows = snapshots.read_snapshots(spark, [str(p) for p in sorted(tmp_path.glob("*.csv"))]).collect()
    got = {r["subjectid"]: (r["network"], r["timepoint"], r["a"], r["b"]) for r in rows}
    assert got == {"AB1": ("PRONET", "baseline", "", None), "AB2": ("PRONET", "baseline", "NA", None), "CD1": ("PRESCIENT", "month1", None, "5")}


def test_runs_rotate(spark, tmp_path):
    path = str(tmp_path / "flags")
    for day in ("2024-01-01", "2024-01-02"):
        outputs.write_flags(spark.createDataFrame([("a", "PRONET", day)], "subject string, network string, message string"), path, day)
    assert [r["message"] for r in outputs.earlier_flags(spark, path, "2024-01-02").collect()] == ["2024-01-01"]
    assert outputs.earlier_flags(spark, path, "2024-01-01").count() == 0


def test_dictionary_tables(spark):
    rows = [
        ("a", "f", "text", "<b>Age</b>", "", "", "y", "", "", "1", "9"),
        ("b", "f", "checkbox", "", "1, Yes", "[a]='1'", "y", "", "", "", ""),
        ("c", "g", "text", "Who", "[c]+1", "[id]<>''", "", "", "date_ymd", "-3", "5"),
        ("id", "g", "text", "Name", "", "", "y", "y", "", "", ""),
    ]
    d = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in snapshots.DICTIONARY_COLUMNS.values()))
    assert {r["variable"]: r["label"] for r in dd.labels(d).collect()} == {"a": "Age", "b": "1, Yes", "c": "Who", "id": "Name"}
    assert {r["variable"]: (r["low"], r["high"]) for r in dd.ranges(d, {}).collect()} == {"a": (1.0, 9.0), "c": (0.0, 5.0)}
    assert [tuple(r) for r in dd.blank_check_variables(d, []).collect()] == [("a", "f", "Main Report")]
    assert {r["form"]: r["non_branch_logic_vars"] for r in dd.always_shown(d).collect()} == {"f": ["a"]}
    assert [tuple(r) for r in dd.identifier_effects(d).collect()] == [("c", "branching_logic", "id")]
    assert [tuple(r) for r in dd.unsupported(d).collect()] == [("c", "identifier")]
    assert sorted(r["variable"] for r in dd.excluded_variables(d, {"N": ["a", "c"]}).collect()) == ["a", "c"]
    assert dd.generated_names(spark, "p", "ab", range(1, 4), items=2).count() == 12
    assert sorted(tuple(r) for r in dd.team_forms(d, {"T": ["f"]}).collect()) == [("Non Team Forms", "g"), ("T", "f")]


def test_cell_changes_ignore_spelling(spark):
    before = spark.createDataFrame([(1, "2", "x"), (2, "3", "y")], "k int, a string, b string")
    after = spark.createDataFrame([(1, "2.0", "z"), (3, "3", "y")], "k int, a string, b string")
    assert [tuple(r) for r in diffs.changed_cells(before, after, ["k"]).collect()] == [(1, "b", "x", "z")]

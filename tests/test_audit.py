"""P25, F10, A27 in whole."""

from pyspark.sql import functions as F

from tallyward.functions import predicates
from tallyward.operators import discovery


def test_own_predicates_of_variables(spark):
    rows = {
        "chrtbi_age_first_inj": "", "chrtbi_parent_age4": "[z]='1'", "chrtbi_age5": "", "chrpharm_med3_onset_past": "", "chrpharm_med1_offset_past": "[z]='1'", "chrpharm_med3_onset": "[z]='1'",
        "chrpsychs_av_qual_desc": "", "chrscid_b45": "[z]='1'", "chrscid_b48": "", "chrscid_c56_c65": "[z]='1'", "chrpsychs_scr_e24": "datediff([a])>3", "chrdig_notes_5": "", "other": "[z]='1'",
    }
    made = {r["variable"]: r for r in predicates.compiled(spark.createDataFrame(list(rows.items()), "variable string, branching_logic string")).collect()}
    assert all(r["rest"] == "" for r in made.values())

    def holds(variable, **cells):
        one = spark.createDataFrame([tuple(cells.values())], ", ".join(f"`{c}` string" for c in cells))
        return one.select(F.expr(predicates.applicable(made[variable]["predicate"], one.columns).text).alias("x")).first()["x"]

    for variable, yes, no in [
        ("chrtbi_age_first_inj", {"chrtbi_parent_headinjury": "1"}, {"chrtbi_parent_headinjury": "0"}),
        ("chrtbi_parent_age4", {"chrtbi_number_injs": "4", "chrtbi_parent_times": "3"}, {"chrtbi_number_injs": "4", "chrtbi_subject_times": "3"}),
        ("chrtbi_age5", {"chrtbi_number_injs": "5", "chrtbi_subject_times": "3"}, {"chrtbi_number_injs": "4", "chrtbi_subject_times": "3"}),
        ("chrpharm_med3_onset_past", {"chrpharm_med2_add_past": "1"}, {"chrpharm_med2_add_past": "1", "chrpharm_med3_name_past": "999"}),
        ("chrpharm_med1_offset_past", {"chrpharm_med_past": "1"}, {"z": "1"}),
        ("chrpharm_med3_onset", {"z": "1"}, {"z": "0"}),
        ("chrpsychs_av_qual_desc", {"chrpsychs_av_quality": "0"}, {"chrpsychs_av_quality": "1"}),
        ("chrscid_b45", {"z": "1", "chrscid_b40": "3", "chrscid_b41": "3"}, {"z": "1", "chrscid_b40": "3", "chrscid_b42": "3"}),
        ("chrscid_b48", {"chrscid_b38": "3"}, {"chrscid_b38": "3", "chrscid_b49___1": "1"}),
        ("chrscid_c56_c65", {"z": "1"}, {"z": "1", "chrscid_b23___1": "1"}),
        ("chrpsychs_scr_e24", e24 := {"chrpsychs_scr_ac1": "0", "chrpsychs_scr_e4": "1", "chrpsychs_scr_e21": "0", "chrsofas_currscore": "90", "chrsofas_premorbid": "100"}, e24 | {"chrsofas_premorbid": "0"}),
        ("chrdig_notes_5", {"chrdig_reason_missing": "3.0", "chrdig_motivational": "x"}, {"chrdig_reason_missing": "3.0", "chrdig_motivational": ""}),
    ]:
        assert holds(variable, **yes) and not holds(variable, **no), variable


def test_audit_takes_eligible_cells_only(spark):
    cells = [("a", "0", "2", "PRONET"), ("a", "1", "2", "PRONET"), ("a", "0", "1", "PRONET"), ("a", None, None, "PRONET"), ("a_notes", "0", "2", "PRONET"), ("gone", "0", "2", "PRONET"), ("b", "0", "2", "PRONET"), ("c", "0", "2", "PRONET"), ("c", "0", "2", "PRESCIENT")]
    long = spark.createDataFrame([(str(i), *c, "5", False) for i, c in enumerate(cells)], "subject string, variable string, missing string, complete string, network string, value string, applies boolean")
    of = lambda *x: spark.createDataFrame([(y,) for y in x], "variable string")
    rows = discovery.auditable(long, of("a", "a_notes", "b", "c"), of("b"), of("c"))
    found = discovery.applicability_audit(rows, [], "subject").collect()
    assert {r["variable"]: r["subjects"] for r in found} == {"a": ["0", "3"], "c": ["8"]}


def test_final_scores_keep_deviating_pairs_and_list_them(spark):
    pairs = spark.createDataFrame([("s", f"p{i}", 2.0 if i % 2 else 0.5, 0.1 if i < 7 else 3.0) for i in range(10)], "k string, pair string, global_deviation double, local_deviation double")
    outliers = spark.createDataFrame([("s", 2.0)], "k string, z double")
    [got] = discovery.final_scores(pairs, outliers, ["k"]).collect()
    assert got["n"] == 6 and got["pairs"] == ["p1", "p3", "p5", "p7", "p8", "p9"] and abs(got["global_total"] - 10.5) < 1e-9
    assert discovery.final_scores(pairs.where(F.col("pair") != "p1"), outliers, ["k"]).count() == 0

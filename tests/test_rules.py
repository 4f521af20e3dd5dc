from datetime import date

from pyspark.sql import functions as F

from tallyward.functions import values as v
from tallyward.functions.expressions import lit
from tallyward.operators import catalog, gate, rules
from tallyward.operators.flags import flag_records
from tallyward.plans import model


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{n} string" for n in names))


def fired(spark, made, **columns):
    """The rules that fire, by row number."""
    n = len(next(iter(columns.values())))
    rows = frame(spark, i=[str(k) for k in range(n)], **columns)
    out = {k: set() for k in range(n)}
    for r in rules.evaluate(rows, made, ["i"]).collect():
        out[int(r["i"])].add(r["rule"])
    return [out[k] for k in range(n)]


def test_rules_need_their_columns_and_respect_exclusions(spark):
    rule = rules.outside("r", "x", 0, 10)
    assert fired(spark, [rule], x=["11", "-9", "", "a", None, "10", "-1"]) == [{"r"}, set(), set(), set(), set(), set(), {"r"}]
    assert fired(spark, [rule], y=["11"]) == [set()]
    rows = frame(spark, i=["0"], x=["11"])
    assert rules.evaluate(rows, [rule], ["i"], excluded=frozenset({"x"})).count() == 0
    assert rules.evaluate(rows, [rule], ["i"], gate=lambda form: lit(False)).count() == 1  # no forms, nothing to gate


def test_value_sets(spark):
    made = [rules.in_set("in", "x", [1, 2]), rules.in_set("out", "x", [1, 2], negate=True)]
    assert fired(spark, made, x=["1.0", "3", "", "-9", "a", None]) == [{"in"}, {"out"}, set(), set(), {"out"}, set()]


def test_more_rules_than_one_projection(spark):
    many = [rules.outside(f"r{n}", "x", None, n) for n in range(120)]
    assert rules.evaluate(frame(spark, i=["0"], x=["60"]), many, ["i"]).count() == 60


def test_blood_rules(spark):
    made = catalog.blood_rules(("vol",), ("bar",), lit("2024-03-01").cast("date"))
    base = {"network": ["PRONET"] * 4}
    assert fired(spark, made, vol=["0", "1.2", "1", "-9"], **base) == [{"volume vol"}, {"volume vol"}, set(), set()]
    assert fired(spark, made, bar=["123", "12345678ab", "1234567890", "pronet1"], **base) == [{"short bar"}, {"digits bar"}, set(), set()]
    dates = {"chrblood_drawdate": ["2024-01-02 10:00", "2024-01-02 10:00", "bad", "-9"], "chrblood_labdate": ["2024-01-02 09:00", "2024-01-02 11:00", "2024-01-02 11:00", "2024-01-01 11:00"]}
    assert fired(spark, made, **dates, **base) == [{"draw before lab"}, set(), set(), set()]
    assert fired(spark, made, chrcbc_wbc=["10", "10", "10", "-9"], chrcbc_wbcsum=["8.9", "9", "11.1", "5"], **base) == [{"white cells"}, set(), {"white cells"}, set()]
    assert fired(spark, made, chrcbc_rbc=["13", "13"], network=["PRONET", "PRESCIENT"]) == [{"units chrcbc_rbc"}, set()]
    sent = {"cbc_with_differential_complete": ["0", "0", "2", "2"], "chrblood_cbc": ["1", "1", "0", "1"], "chrblood_interview_date": ["2024-02-01", "2024-02-28", "2024-02-01", "2024-02-01"]}
    assert fired(spark, made, **sent, **base) == [{"sent, not complete"}, set(), {"complete, not sent"}, set()]


def test_clinical_rules(spark):
    made = catalog.clinical_rules()
    assert fired(spark, made, chroasis_oasis_1=["0", "0", "1"], chroasis_oasis_2=["1", "-9", "1"]) == [{"anxiety 2"}, set(), set()]
    assert fired(spark, made, chrcssrsb_si1l=["2", "2", "1"], chrcssrsb_css_sim1=["1.0", "2", "1"]) == [{"lifetime chrcssrsb_si1l"}, set(), set()]
    tbi = {"chrtbi_parent_headinjury": ["1", "1", "0"], "chrtbi_subject_head_injury": ["0", "0", "-9"], "chrtbi_sourceinfo": ["3", "1", "3"]}
    assert fired(spark, made, **tbi) == [{"head injury"}, {"informants"}, set()]
    assert fired(spark, made, chrbprs_bprs_susp=["6", "6"], chrbprs_bprs_unus=["1", "2"], visit_status_string=["converted", "converted"]) == [{"susp and unusual"}, set()]
    assert fired(spark, made, chrscid_c10=["3", "3", "2"], visit_status_string=["month1", "converted", "month1"]) == [{"conversion chrscid_c10"}, set(), set()]
    gf = {"chrgfs_gf_social_low": ["7", "5"], "chrgfs_gf_social_scale": ["6", "6"], "chrgfs_gf_social_high": ["8", "8"]}
    assert fired(spark, made, **gf) == [{"extreme chrgfs_gf_social_low"}, set()]
    assert fired(spark, made, age=["20", "20", "20"], chrpps_fage=["25", "40", "-9"]) == [{"age difference chrpps_fage"}, set(), set()]


def test_diagnosis_rules(spark):
    made = catalog.scid_rules({"chrscid_d": {"criteria": ["chrscid_x", "chrscid_y"], "disorder": "D"}})
    assert fired(spark, made, chrscid_x=["3", "3", "1"], chrscid_y=["3", "3", "3"], chrscid_d=["1", "3", "3"]) == [{"diagnosis chrscid_d"}, set(), {"no diagnosis chrscid_d"}]
    assert fired(spark, made, chrscid_a70=["3", "1", "1"], chrscid_a108=["1", "1", "1"], chrscid_d2=["1", "3", "1"]) == [{"manic episode"}, {"manic episode"}, set()]
    assert fired(spark, made, chrscid_a27=["3", "3", "3"], chrscid_a28=["3", "3", "1"], chrscid_a48_1=["1", "2", "1"]) == [{"depressed mood"}, set(), {"depressed mood"}]
    assert fired(spark, made, chrscid_a26_53=["0", "2", "-9"], chrscid_a25=["3", "1", "3"], chrscid_a51=["1", "1", "1"]) == [{"episode count"}, {"episode count"}, set()]


def test_medication_rules(spark):
    columns = ["chrpharm_med1_onset", "chrpharm_med2_onset", "chrpharm_date_mod"]
    made = catalog.latest_onset(columns)
    assert fired(spark, made, chrpharm_med1_onset=["2024-01-01", "2024-01-01"], chrpharm_med2_onset=["2024-01-10", "-9"], chrpharm_date_mod=["2024-01-15", "2024-01-15"]) == [set(), {"latest onset"}]
    made = catalog.unknown_names(["chrpharm_med1_name", "chrpharm_med1_dosage"])
    assert fired(spark, made, chrpharm_med1_name=["888", "888", "5"], chrpharm_med1_dosage=["5", "", "5"]) == [{"unknown medication"}, set(), set()]
    rows = frame(spark, s=["a"], med1_name=["5"], med1_on=["2024-01-01"], med1_off=["2024-01-10"], med2_name=["5"], med2_on=["2024-01-10"], med2_off=["2024-02-01"], med3_name=[""], med3_on=[""], med3_off=[""])
    slots = rules.slots(rows, ["s"], 3, {"name": "med{n}_name", "on": "med{n}_on", "off": "med{n}_off"})
    assert [tuple(r) for r in rules.repeated_in_slots(slots, ["s"], "name").collect()] == [("a", "5", 1, 2)]
    assert [tuple(r) for r in rules.overlapping(slots, ["s", "name"], "on", "off", "slot").collect()] == [("a", "5", 1, 2)]


def test_gate(spark):
    form = gate.Form("f", "f_complete", "f_missing", "f_date", ("a", "b"))
    rows = frame(spark, subjectid=list("123456"), network=["PRONET"] * 5 + ["PRESCIENT"], cohort=["CHR", "HC", "unknown", "CHR", "CHR", "CHR"], timepoint=["baseline"] * 6, visit_status_string=["month1"] * 6, f_complete=["2", "2.0", "2", "2", "0", "0"], f_missing=["0", "0", "0", "1", "0", "0"], f_date=[""] * 6, a=["1"] * 6, b=["1"] * 6)
    rows = gate.with_ordinals(rows, model.timepoints(spark))
    due = spark.createDataFrame([("CHR", "baseline", ["f"]), ("HC", "baseline", ["g"])], "cohort string, timepoint string, forms array<string>")
    ready, ok = gate.gated(rows, [form], due)
    assert {r["subjectid"]: r["ok"] for r in ready.select("subjectid", F.expr(ok("f").text).alias("ok")).collect()} == {"1": True, "2": False, "4": False, "5": False, "6": True}


def test_flag_records(spark):
    rows = spark.createDataFrame([("AB1", "PRONET", "screening", "", "included", "5"), ("AB2", "PRONET", "month1", "True", "included", "5")], "subjectid string, network string, timepoint string, removed string, inclusion_status string, x string")
    found = rules.evaluate(rows, [rules.outside("r", "x", None, 1, forms=("f",))], ["subjectid", "network", "timepoint", "removed", "inclusion_status"])
    out = {r["subject"]: r for r in flag_records(found, F.lit("2024-01-01"), spark.createDataFrame([("x", "X label")], "variable string, label string")).collect()}
    assert out["AB1"]["reports"] == ["Main Report"] and out["AB2"]["reports"] == []
    assert out["AB1"]["site"] == "AB" and out["AB1"]["priority_item"] and not out["AB2"]["priority_item"]
    assert out["AB1"]["dates_detected"] == [date(2024, 1, 1)] and out["AB1"]["var_translations"] == ["X label"]
    assert out["AB1"]["error_message"] == "x : x is out of range (value = 5)"


def test_long_path(spark):
    long = rules.long_form(frame(spark, k=["1", "2", "3"], a=["", "-9", "7"], b=["NaN", None, "2"]), ["k"], ["a", "b"])
    table = spark.createDataFrame([("a",), ("b",)], "variable string")
    assert [(r["k"], r["variable"]) for r in rules.blank_checks(long, table).collect()] == [("1", "a")]
    assert sorted((r["k"], r["variable"]) for r in rules.missing_code_checks(long, table).collect()) == [("1", "b"), ("2", "a")]
    ranges = spark.createDataFrame([("a", 0.0, 5.0), ("b", 0.0, 5.0)], "variable string, low double, high double")
    assert [(r["k"], r["variable"]) for r in rules.range_checks(long, ranges).collect()] == [("3", "a")]


def test_labels_and_ages(spark):
    rows = frame(spark, x=["1.0", "2", "7", ""], m=["-9", "240", "abc", "0"], n=["246", "", "", "-3"])
    assert [r[0] for r in rows.select(model.label(model.COHORTS, "x")).collect()] == ["CHR", "HC", "unknown", "unknown"]
    assert [r[0] for r in rows.select(model.age_in_years("m", "n")).collect()] == ["20.5", "20.0", "unknown", "0.0"]
    assert v.filled("x") is not None

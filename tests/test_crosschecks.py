from tallyward.operators import crosschecks, rules


def test_checks_across_tables_and_timepoints(spark):
    rows = spark.createDataFrame([("a", "baseline", ""), ("b", "baseline", "2024-01-01"), ("c", "month1", "-9"), ("d", "baseline", "")], "subjectid string, timepoint string, chrconv_interview_date string")
    conversions = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-01"), ("c", "2024-01-01"), ("d", None)], "subject string, conversion_date string")
    assert sorted(r["subjectid"] for r in crosschecks.unrecorded_conversions(rows, conversions).collect()) == ["a", "c"]
    legacy = spark.createDataFrame([("a", "baseln", "IQ Assessment Wasii", "Conversion one | other|Conversion two"), ("c", "month1", "Other", "Conversion")], "subject string, timepoint string, general_flag string, specific_flags string")
    assert sorted(r["error_message"] for r in crosschecks.carried_flags(rows, legacy).collect()) == ["Conversion one", "Conversion two"]
    wide = spark.createDataFrame([("a", "40", "41.0"), ("b", "40", "40.0"), ("c", "-9", "40"), ("d", None, "40")], "subjectid string, chrpps_mage_baseline string, chrfigs_mother_age_screening string")
    assert [r["subjectid"] for r in rules.evaluate(wide, crosschecks.differing_ages(), ["subjectid"]).collect()] == ["a"]
    tests = spark.createDataFrame([("20", "2024-01-01", "2024-12-31", "2.0"), ("unknown", "2024-01-01", "2024-12-31", "7")], "age string, demographics_date string, chriq_interview_date string, chriq_assessment string")
    got = tests.select(crosschecks.age_at_test().alias("age"), crosschecks.assessment().alias("kind")).collect()
    assert [(r["age"], r["kind"]) for r in got] == [(21.0, 2), (None, None)]

"""Flags as a bucketed state, and files of a run."""

from pyspark.sql import functions as F

from tallyward.operators import lifecycle
from tallyward.sources import outputs, snapshots, state

SCHEMA = "subject string, displayed_form string, displayed_timepoint string, displayed_variable string, error_message string, seq int, network string, reports array<string>, dates_detected array<date>, dates_resolved array<date>, currently_resolved boolean, comments string"


def flags(spark, day, *names):
    rows = [(f"S{n}", None if n % 2 else "f", "baseline", "x", f"m{n}", n, "PRONET", ["Main Report"], [], [], False, "") for n in names]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"dates_detected": F.array(F.lit(day).cast("date")), "dates_resolved": F.array().cast("array<date>")})


def test_steps_over_a_state_equal_plain_steps(spark, tmp_path):
    days = {"2024-01-01": (1, 2, 3, 4), "2024-01-02": (2, 3, 5), "2024-01-03": (1, 3, 5, 6), "2024-01-04": ()}
    plain = held = None
    for day, names in days.items():
        new, run_date = flags(spark, day, *names), F.lit(day).cast("date")
        plain = lifecycle.step(plain if plain is not None else new.where("false"), new, run_date)
        after = lifecycle.step(held, new, run_date) if held is not None else lifecycle.step(new.where("false"), new, run_date)
        if held is not None:
            above = after._jdf.queryExecution().executedPlan().toString()
            assert above.count("Exchange hashpartitioning(flag_key") <= 1  # of the new side alone
            assert "SelectedBucketsCount: 4 out of 4" in above
        state.save(after, str(tmp_path), day, "tested", buckets=4)
        spark.sql(f"DROP TABLE tested_{day.replace('-', '')}")  # as another session would find it
        held = state.load(spark, str(tmp_path), day, "tested", buckets=4)
        columns = ["subject", "error_message", "dates_detected", "dates_resolved", "currently_resolved", "time_since_last_detection"]
        assert sorted(map(str, held.select(columns).collect())) == sorted(map(str, plain.select(columns).collect())), day
        assert {p.name for p in (tmp_path / f"run_date={day}").iterdir() if p.is_dir()} <= {"currently_resolved=true", "currently_resolved=false"}


def test_files_of_reviewers_raters_changes_and_records(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    raters = [put("r/a.csv", "RAname,subjectkey\nann,S1\nann,S1\n,S2\n"), put("r/b.csv", "RAname,subjectkey\nbo,S3\nann,S0\n")]
    assert {(r["rater"], tuple(r["subjects"])) for r in snapshots.read_raters(spark, raters).collect()} == {("ann", ("S0", "S1")), ("bo", ("S3",))}
    status = [put("s/AB12345_status.csv", "Transition / Conversion\n05/02/2024\n06/02/2024\n"), put("s/AB54321_status.csv", "Transition / Conversion\nnone\n")]
    assert {tuple(r) for r in snapshots.read_conversions(spark, status).collect()} == {("AB12345", "2024-02-05"), ("AB54321", None)}
    changes = [put("c/diff_2024-03-01.csv", "a\n1\n2\n"), put("c/diff_2024-03-02.csv", "a\n")]
    assert [r["date"] for r in snapshots.read_changes(spark, changes).collect()] == ["2024-03-01", "2024-03-01"]
    sheet = put("v/sheet.csv", "Participant,Timepoint,Form,Flags,Manually Resolved,Network Comments,Site Comments\nS1,baseline,f,m,yes,c,d\n")
    assert snapshots.read_reviews(spark, [sheet]).first().asDict() == {"subject": "S1", "displayed_timepoint": "baseline", "displayed_form": "f", "flags": "m", "manually_resolved": "yes", "comments": "c", "site_comments": "d"}
    outputs.write_records(spark, [{"a": 1}], "a int", str(tmp_path / "records"))
    outputs.write_baseline(spark.read.parquet(str(tmp_path / "records")), str(tmp_path / "baseline"))
    assert spark.read.parquet(str(tmp_path / "baseline")).first()["a"] == 1


def test_trackers_and_flags_as_files(spark, tmp_path):
    rows = spark.createDataFrame([("S2", "PRONET", "Main Report", "S2", "baseline", "f", 1, "late", 1), ("S1", "PRONET", "Main Report", "S2", "baseline", "f", 1, "open", 0), ("S3", "PRESCIENT", "Blood Report", "S3", "baseline", "f", 1, "x", 0)], "subject string, network string, report string, site string, displayed_timepoint string, displayed_form string, flag_count int, flags string, bucket int")
    outputs.write_tracker(rows, str(tmp_path / "t"))
    assert len({p.parent for p in (tmp_path / "t").rglob("*.csv")}) == 2
    back = spark.read.option("header", True).csv(str(tmp_path / "t" / "network=PRONET"))
    assert [r["Flags"] for r in back.collect()] == ["open", "late"] and {"Participant", "Flag Count"} <= set(back.columns)
    for day, names in {"2024-01-01": (1,), "2024-01-02": (1, 2)}.items():
        outputs.write_flags(flags(spark, day, *names), str(tmp_path / "flags"), day)
    assert outputs.earlier_flags(spark, str(tmp_path / "flags"), "2024-01-03").count() == 2 and outputs.earlier_flags(spark, str(tmp_path / "flags"), "2024-01-01").count() == 0

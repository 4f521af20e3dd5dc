"""What the studies' dictionary holds that no rule gives: fixed values of forms, variables and reports, and the tables made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import predicates
from tallyward.functions.expressions import Sql, lit
from tallyward.operators.gate import Form, skips_modules
from tallyward.plans import dictionary as dd

# Forms.
BLOOD, SCID = "blood_sample_preanalytic_quality_assurance", "scid5_psychosis_mood_substance_abuse"
PSYCHS_FORMS = ("psychs_p1p8", "psychs_p1p8_fu", "psychs_p1p8_fu_hc", "psychs_p9ac32", "psychs_p9ac32_fu", "psychs_p9ac32_fu_hc")
SELF_REPORTS = (
    "item_promis_for_sleep", "oasis", "perceived_discrimination_scale", "perceived_stress_scale", "pgis", "psychosis_polyrisk_score", "pubertal_developmental_scale",
)
EXPOSURE = "lifetime_ap_exposure_screen"
MISSING_CODE_FORMS = {"PRONET": (EXPOSURE,), "PRESCIENT": (EXPOSURE, SCID)}
TEAMS = {
    "Blood Report": [BLOOD, "cbc_with_differential"],
    "Cognition Report": ["penncnb", "premorbid_iq_reading_accuracy", "iq_assessment_wasiii_wiscv_waisiv"],
    "Scid Report": [SCID],
    "MRI Report": ["mri_run_sheet"],
    "EEG Report": ["eeg_run_sheet"],
    "Digital Report": [
        "digital_biomarkers_mindlamp_onboarding", "digital_biomarkers_mindlamp_checkin", "digital_biomarkers_mindlamp_end_of_12month_study_p",
        "digital_biomarkers_axivity_onboarding", "digital_biomarkers_axivity_checkin", "digital_biomarkers_axivity_end_of_12month_study_pe",
    ],
    "Fluids Report": ["daily_activity_and_saliva_sample_collection", BLOOD, "cbc_with_differential", "current_health_status"],
}

# Texts that mark a form's special variables, and variables whose texts differ.
MISSING_TEXT = "click if this form is missing all of its data"
REASON_TEXT = "M1, M1 - Measure refusal (no reason provided) | M2, M2 - No show | M3, M3 - Research assistant forgot | M4, M4 - Uncontrollable circumstance | M5, M5 - Participant dropped out"
INTERVIEW_TEXTS, ENTRY_TEXTS = ["Date of Interview", "Interview date", "Interview Date"], ["Date of Data Entry"]
MORE_INTERVIEW_DATES = (
    "chrap_date", "chrbccs_review_date", "chrblood_interview_date", "chrcbc_interview_date", "chrchs_interview_date", "chrconv_interview_date", "chrcrit_date", "chreeg_interview_date",
    "chrgpc_date", "chric_consent_date", "chric_reconsent_date", "chrmri_entry_date", "chrpred_interview_date", "chrsaliva_interview_date", "enrollmentnote_dateofconsent",
)
MORE_ENTRY_DATES = ("chrblood_entry_date", "chrpred_entry_date", "chrsaliva_entry_date")
MORE_USERS = ("chrcssrsfu_redacp_user", "chrpps_redcao_user")
ADDED_LATER = {SCID: ("chrscid_missing", "2024-12-25")}

# Variables checked for blanks besides the required ones.
MORE_BLANK_CHECKS = (
    "chrblood_rack_barcode", "chrchs_timeslept", "chrcrit_inc3", "chrcrit_included", "chrdemo_age_mos2", "chrdemo_age_mos_chr", "chrdemo_age_mos_hc", "chroasis_oasis_1", "chroasis_oasis_3", "chrpsychs_av_dev_desc",
)

# Texts of excluded variables' names.
EXCLUDED = (
    "comment", "note", "chrblood_pl1id_2", "chrcssrsb_cssrs_yrs_sb", "chrcssrsb_nmapab", "chrcssrsb_sb6l", "chrcssrsfu_skip_aa", "chrdbb_phone_model", "chrdbb_phone_software", "chrdemo_parent_fa", "chrdemo_parent_mo",
    "chric_smartphone", "chric_surveys", "chrmri_dmri176_qc", "chrmri_t2_ge", "chrpas_pmod_adult3v1", "chrpas_pmod_adult3v3",
)
EXCLUDED_SCID = (
    "a106", "a11", "a111", "a112", "a120", "a173", "a26_53", "a37", "a40", "a41", "a46", "a47", "a5", "a7", "a8", "a94", "as", "as43",
    "b15", "b45", "b46", "b47", "b48", "b50", "b51", "b52", "b53", "b55", "b56", "b57", "b58", "b60", "b61", "b62", "b63", "c56_c65",
    "cur_diagnosis", "d2", "d29", "d45_d49_d54_d56", "d5", "d59", "d61_d65", "diagnosis_ruled_out",
    "e153", "e16", "e167", "e168_306", "e19_37", "e203_205", "e207", "e21", "e304", "e333", "e334", "e46", "e48_50", "entry_date", "opioids_yn", "remote",
)
EXCLUDED_PRESCIENT = (
    "chrblood_freezerid", "chrblood_rack_barcode", "chrdemo_racial", "chrpps_ausgrade", "chrsaliva_food", "se2id", "se3id", "wb2id", "wb3id",
    "chrscid_a119", "chrscid_overview_version", *(f"chrscid_{x}_yn" for x in ("cannabis", "hallucinogen", "inhalant", "othersub", "phencyclidine", "sedhypanx", "stimulant")),
)
SUBSTANCES = 15

# Values that are flagged as they are.
SPECIFIC_VALUES = [
    ("chrspeech_upload", [0.0], "Speech sample not uploaded to Box", ["Secondary Report"]),
    ("chrpenn_complete", [2.0, 3.0], "Penncnb not completed (value is either 2 or 3).", ["Secondary Report", "Cognition Report"]),
]


def special_kinds() -> list[tuple[str, str, list[str]]]:
    """P10: (kind, dictionary column, texts) of special variables."""
    return [("missing_var", "choices", [MISSING_TEXT]), ("missing_spec_var", "choices", [REASON_TEXT]), ("interview_date_var", "label", INTERVIEW_TEXTS), ("entry_date_var", "label", ENTRY_TEXTS)]


def special_variables(dictionary: DataFrame) -> DataFrame:
    """P10: (form, kind, variable, position): by their texts, then by name; later positions win. Only dates leave out names with err or invalid."""
    name = F.col("variable")
    dates = ~name.rlike("err|invalid")
    found = None
    by_name = {"interview_date_var": name.isin(*MORE_INTERVIEW_DATES), "entry_date_var": name.isin(*MORE_ENTRY_DATES), "redcap_user_var": name.endswith("redcap_user") | name.isin(*MORE_USERS)}
    tests = [(kind, dd.any_text(column, texts), 0) for kind, column, texts in special_kinds()] + [(kind, test, 1) for kind, test in by_name.items()]
    for kind, test, position in tests:
        part = dictionary.where(test & dates if "date" in kind else test).select("form", F.lit(kind).alias("kind"), "variable", F.lit(position).alias("position"))
        found = part if found is None else found.unionByName(part)
    return found


KINDS = ["missing_var", "missing_spec_var", "interview_date_var", "entry_date_var", "redcap_user_var"]


def metadata(dictionary: DataFrame) -> DataFrame:
    """One row for each form."""
    forms = dictionary.select("form").distinct()
    always = dd.always_shown(dictionary)
    found = dd.form_metadata(special_variables(dictionary), KINDS, always).drop("completion_var", "non_branch_logic_vars")
    return forms.join(found, "form", "left").join(always, "form", "left").withColumn("completion_var", F.concat("form", F.lit("_complete")))


def blood_groups(dictionary: DataFrame) -> DataFrame:
    """(grp, variable) of the blood form: positions, identifiers, volumes, barcodes."""
    name = F.col("variable")
    tests = {
        "position": name.contains("pos"), "id": name.contains("id") & (name != "chrblood_pl1id_2"), "volume": name.contains("vol") & ~name.contains("error"), "barcode": F.col("label").contains("barcode"),
    }
    groups = F.filter(F.array(*[F.when(t, g) for g, t in tests.items()]), lambda x: x.isNotNull())
    return dictionary.where(F.col("form") == BLOOD).select(F.explode(groups).alias("grp"), "variable")


def module_groups(dictionary: DataFrame) -> DataFrame:
    """(grp, variable) of two diagnosis modules, b by its prefix, c by a number from 1 to 79 anywhere in the name; each variable once."""
    scid = dictionary.where(F.col("form") == SCID)
    b = F.col("variable").contains("chrscid_b") & ~F.col("variable").isin("chrscid_bipolar_sub_desc", "chrscid_bp_current_severity", "chrscid_bp_recent_ep")
    groups = F.filter(F.array(F.when(b, "module_b"), F.when(F.col("variable").rlike("c[1-9]"), "module_c")), lambda x: x.isNotNull())
    return scid.select(F.explode(groups).alias("grp"), "variable")


MEDICATION_FIELDS = ("onset", "offset", "use", "dosage", "comp", "indication")


def medication_groups(dictionary: DataFrame) -> DataFrame:
    """(grp, variable) of the medication forms."""
    name = F.col("variable")
    tests = {"name": name.contains("name") & name.contains("chrpharm"), "firstdose": name.contains("firstdose"), "status": name.rlike(r"^chrpharm_med\d*_mo\d*"), "timepoint": name.contains("chrpharm_med") & name.contains("_tp")}
    tests |= {f: name.rlike(rf"^chrpharm_med\d*_{f}") for f in MEDICATION_FIELDS}
    groups = F.filter(F.array(*[F.when(t, g) for g, t in tests.items()]), lambda x: x.isNotNull())
    return dictionary.where(F.col("form").contains("pharmaceutical")).select(F.explode(groups).alias("grp"), "variable")


def psychs_variables(spark) -> DataFrame:
    """The essential items: screening b5, b6, b19, d16, d30, follow-ups d16, d30, both with and without app, and the totals."""
    item = F.explode(F.sequence(F.lit(1), F.lit(dd.PSYCHS_ITEMS))).alias("item")
    kinds = [("chrpsychs_scr_", x) for x in ("b5", "b6", "b19", "d16", "d30")] + [(p, x) for p in ("chrpsychs_fu_", "hcpsychs_fu_") for x in ("d16", "d30")]
    rows = spark.createDataFrame(kinds, "prefix string, suffix string").select("prefix", "suffix", item)
    names = rows.select(F.concat("prefix", F.col("item").cast("string"), "suffix").alias("variable"))
    more = spark.createDataFrame([(f"{p}e{n}",) for p, n in (("chrpsychs_scr_", 11), ("chrpsychs_scr_", 27), ("chrpsychs_fu_", 27), ("hcpsychs_fu_", 27))], "variable string")
    every = names.unionByName(more)
    return every.unionByName(every.select(F.concat("variable", F.lit("_app")).alias("variable")))


def blank_checks(dictionary: DataFrame) -> DataFrame:
    """(variable, form, report): required variables and further ones; notes and self-reports go to the secondary report."""
    name = F.col("variable")
    essential = psychs_variables(dictionary.sparkSession).select("variable", F.lit(True).alias("essential"))
    rows = dictionary.where(F.col("identifier") != "y").join(essential, "variable", "left")
    further = F.coalesce("essential", F.lit(False)) | name.isin(*MORE_BLANK_CHECKS) | (name.contains("chrpharm_med") & name.contains("name_past")) | (F.col("form") == SCID) | ((F.col("form") == EXPOSURE) & (name != "chrap_missing"))
    must = (F.col("required") == "y") & (F.col("field_type") != "checkbox") & ~F.col("form").isin(*PSYCHS_FORMS)
    note, own = F.col("field_type").isin("notes", "descriptive"), F.col("form").isin(*SELF_REPORTS)
    reports = F.filter(F.array(F.when((~note | further) & ~own, "Main Report"), F.when(note | own, "Secondary Report")), lambda x: x.isNotNull())
    return rows.where(must | further).select("variable", "form", F.explode(reports).alias("report"))


def missing_code_checks(dictionary: DataFrame) -> DataFrame:
    """(network, variable)."""
    return dd.missing_code_variables(dictionary, {n: list(forms) for n, forms in MISSING_CODE_FORMS.items()})


def specific_values(dictionary: DataFrame) -> DataFrame:
    """(variable, form, codes, negate, message, reports): two listed rules and a zero in each app item, for variables of the dictionary."""
    spark = dictionary.sparkSession
    listed = spark.createDataFrame([(x, codes, False, message, reports) for x, codes, message, reports in SPECIFIC_VALUES], "variable string, codes array<double>, negate boolean, message string, reports array<string>")
    app = psychs_variables(spark).where(F.col("variable").contains("app")).select("variable", F.array(F.lit(0.0)).alias("codes"), F.lit(False).alias("negate"), F.lit("value is 0").alias("message"), F.array(F.lit("Main Report"), F.lit("Non Team Forms")).alias("reports"))
    return dictionary.select("variable", "form").join(listed.unionByName(app), "variable")


def excluded(dictionary: DataFrame, added: DataFrame | None = None) -> DataFrame:
    """P20: (network, variable)."""
    names = [*EXCLUDED, *(f"chrscid_{x}" for x in EXCLUDED_SCID)]
    own = [*names, *EXCLUDED_PRESCIENT, *(f"chrscid_s{n}_yn" for n in range(1, SUBSTANCES + 1))]
    found = dd.excluded_variables(dictionary, {"PRONET": names, "PRESCIENT": own}, added)
    return found.unionByName(dictionary.where(F.col("form").contains("gcp")).select(F.lit("PRESCIENT").alias("network"), "variable")).distinct()


def teams(dictionary: DataFrame) -> DataFrame:
    """(report, form)."""
    return dd.team_forms(dictionary, TEAMS, always=(SCID,))


def with_teams(found: DataFrame, members: DataFrame) -> DataFrame:
    """A flag's reports and those of the teams of its form; members: (report, form), a row for each form of a team."""
    own = F.broadcast(members.groupBy(F.col("form").alias("_form")).agg(F.array_sort(F.collect_set("report")).alias("_teams")))
    joined = found.join(own, F.get("forms", F.lit(0)) == F.col("_form"), "left")
    return joined.withColumn("reports", F.array_distinct(F.concat("reports", F.coalesce("_teams", F.array().cast("array<string>"))))).drop("_form", "_teams")


def forms(meta: list[dict]) -> list[Form]:
    """The gate's forms; meta: the rows of `metadata`, one for each form."""
    made = []
    for r in meta:
        flag, since = ADDED_LATER.get(r["form"], (None, None))
        missing = r["missing_var"]
        made.append(Form(r["form"], r["completion_var"], missing, r["interview_date_var"], tuple(r["non_branch_logic_vars"] or ()), since if flag == missing else None))
    return made


def predicate_rows(dictionary: DataFrame) -> DataFrame:
    """(variable, predicate)."""
    return predicates.compiled(dictionary).select("variable", "predicate")


def usable_predicates(rows: list[dict], unsupported: list[dict]) -> dict[str, str | None]:
    """Variable -> SQL, None where it can't be used."""
    bad = {r["variable"] for r in unsupported}
    return {r["variable"]: None if r["variable"] in bad else r["predicate"] for r in rows}


def applies(compiled: dict[str, str | None], columns: list[str]):
    """Variable -> whether it applies in a row; never where its predicate can't be used."""
    known = frozenset(columns)

    def test(variable: str) -> Sql:
        predicate = compiled.get(variable, "")
        return lit(False) if predicate is None else predicates.applicable(predicate, known)

    return test


def skipped(modules: dict[str, set[str]]):
    """variable -> whether its module is skipped in a row; modules: group -> variables."""
    b, c = (frozenset(modules.get(x, ())) for x in ("module_b", "module_c"))
    return lambda x: skips_modules(x, b, c)

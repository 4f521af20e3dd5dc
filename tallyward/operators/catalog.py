"""The fixed rules of the forms: tables of variables, codes and thresholds, turned into `Rule`s.

Names, codes, thresholds and the messages of R9-R19 are fixed values of the studies' forms.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.expressions import Sql, col
from tallyward.functions.values import of_text as cell
from tallyward.operators.rules import Rule, all_of, any_of, implies, ordered, outside, overlapping, pattern, slots, text, tolerance

BLOOD, CBC, SCID = "blood_sample_preanalytic_quality_assurance", "cbc_with_differential", "scid5_psychosis_mood_substance_abuse"
BLOOD_REPORTS = ("Main Report", "Blood Report", "Fluids Report")
SCID_REPORTS = ("Main Report", "Scid Report", "Non Team Forms")
MAIN_AND_REST = ("Main Report", "Non Team Forms")

# Laboratory limits.
CBC_ABOVE = {"chrcbc_wbc": 30, "chrcbc_neut": 20, "chrcbc_rbc": 12, "chrcbc_lymph": 20, "chrcbc_eos": 5, "chrcbc_monos": 5, "chrcbc_baso": 5}
CBC_BELOW = {"chrcbc_monos": 0.1, "chrcbc_hct": 1}
FREEZE_TIMES = ("chrblood_wholeblood_freeze", "chrblood_serum_freeze", "chrblood_plasma_freeze", "chrblood_buffy_freeze")

# Lifetime and recent variables of the suicide scale.
CSSRS_YES = {
    "chrcssrsb_cssrs_actual": "chrcssrsb_sb1l", "chrcssrsb_cssrs_nssi": "chrcssrsb_sbnssibl", "chrcssrsb_cssrs_yrs_ia": "chrcssrsb_sb3l",
    "chrcssrsb_cssrs_yrs_aa": "chrcssrsb_sb4l", "chrcssrsb_cssrs_yrs_pab": "chrcssrsb_sb5l", "chrcssrsb_cssrs_yrs_sb": "chrcssrsb_sb6l",
} | {f"chrcssrsb_si{n}l": f"chrcssrsb_css_sim{n}" for n in range(1, 6)}
CSSRS_COUNTS = {
    "chrcssrsb_idintsvl": "chrcssrsb_css_sipmms", "chrcssrsb_snmacatl": "chrcssrsb_cssrs_num_attempt",
    "chrcssrsb_nminatl": "chrcssrsb_cssrs_yrs_nia", "chrcssrsb_nmabatl": "chrcssrsb_cssrs_yrs_naa",
}

# What makes a conversion.
CONVERTS_ABOVE = {f"chrbprs_bprs_{x}": 5 for x in ("somc", "guil", "gran", "susp", "hall", "unus", "bizb", "conc")}
CONVERTS_AT = (
    {f"chrpsychs_fu_{n}{x}0": 6 for n in range(1, 16) for x in ("c", "d")}
    | {f"chrscid_{x}": 3 for x in ("c10", "c26", "c14", "c37", "c44", "c71", "c78", "c50")}
    | {f"chrscid_{x}": 1 for x in ("d47_d52", "d63", "c11", "c21", "c47", "c28")}
    | {"chrscid_c51": 8}
)

# Ages that a rule compares.
PARENT_AGES = ("chrpps_fage", "chrpps_mage", "chrfigs_mother_age", "chrfigs_father_age")
PARENT_FORMS = {"chrpps": "psychosis_polyrisk_score", "chrfigs": "family_interview_for_genetic_studies_figs"}
ONSET_AGES = tuple(
    f"chrscid_{x}"
    for x in ("c56_c65", "a52", "a109", "c58_c66", "d45_d49_d54_d56", "d61_d65", "e19_37", "e164_302", "e168_306", "e172_310", "e176_314", "e180_318", "e184_322", "e188_326", "e192_330")
)
SPECIAL_MEDICATIONS = (573, 542, 538, 539)
CURRENT_MEDICATION = ("current_pharmaceutical_treatment_floating_med_125", "current_pharmaceutical_treatment_floating_med_2650")
PAST_MEDICATION = ("past_pharmaceutical_treatment",)
#: Fields of a slot that a name of 888 (unknown) contradicts, by the slot's number.
SLOT_FIELDS = ("med{n}_onset", "med{n}_offset", "med{n}_use", "interm_meds", "med{n}_dosage", "med{n}_comp", "med{n}_mo{n}")
EXEMPT_FROM_21_DAYS = (
    "cbc_with_differential", "gcp_cbc_with_differential", "gcp_current_health_status", "psychs_p1p8_fu", "psychs_p1p8_fu_hc", "chrpred_interview_date", "sociodemographics",
)


def _is(x: str, *codes: float) -> Sql:
    return cell.code_in(x, codes)


def blood_rules(volumes: tuple[str, ...], barcodes: tuple[str, ...], run_date: Sql) -> list[Rule]:
    """R9-R15."""
    out = []
    for x in volumes:
        low, high = cell.value(x) <= 0, cell.value(x) > 1.1
        out.append(Rule(f"volume {x}", (x,), low | high, text(f"Volume ({x} = ", col(x), sql.when(low, ") is less than or equal to 0").otherwise(") is greater than 1.1")), (BLOOD,), BLOOD_REPORTS))
    out += [Rule(f"freeze {x}", (x,), cell.value(x) > 480, text(f"Processing time ({x} = ", col(x), ") is greater than 480"), (BLOOD,), BLOOD_REPORTS) for x in FREEZE_TIMES]
    out.append(ordered("draw before lab", "chrblood_drawdate", "chrblood_labdate", cell.as_minute, forms=(BLOOD,), reports=BLOOD_REPORTS))
    for x in barcodes:
        counted = cell.filled(x) & ~sql.lower(col(x)).contains("pronet")
        out.append(Rule(f"short {x}", (x,), counted & (sql.length(col(x)) < 10), text("Barcode (", col(x), ") length is less than 10 characters."), (BLOOD,), BLOOD_REPORTS, gated=False))
        out.append(Rule(f"digits {x}", (x,), counted & ~cell.is_digits(x), text("Barcode (", col(x), ") contains non-numeric characters."), (BLOOD,), BLOOD_REPORTS, gated=False))
    total = tolerance("white cells", "chrcbc_wbc", "chrcbc_wbcsum", 0.1, forms=(CBC,), reports=BLOOD_REPORTS)
    out.append(total)
    other = col("network") != "PRESCIENT"
    for limits, above in ((CBC_ABOVE, True), (CBC_BELOW, False)):
        out += [
            Rule(f"units {x}", (x,), cell.value(x) > t if above else cell.value(x) < t, text(f"Incorrect units used ({x} = ", col(x), ")"), (CBC,), BLOOD_REPORTS, only=other) for x, t in limits.items()
        ]
    sent, done = _is("chrblood_cbc", 1), _is("cbc_with_differential_complete", 2)
    late = v.days_between(cell.real_date("chrblood_interview_date", True), run_date) > 5
    pair = ("cbc_with_differential_complete", "chrblood_cbc")
    out.append(Rule("sent, not complete", pair, ~done & sent & late, sql.lit("A tube went to the laboratory over five days ago, but the blood count form is still open."), (BLOOD,), BLOOD_REPORTS))
    out.append(Rule("complete, not sent", pair, done & ~sent, sql.lit("The blood count form is complete, although no tube is marked as sent."), (BLOOD,), BLOOD_REPORTS))
    return out


def clinical_rules() -> list[Rule]:
    """R16-R25, R35-R38."""
    out = []
    for n in range(2, 6):
        x = f"chroasis_oasis_{n}"
        out.append(implies(f"anxiety {n}", ("chroasis_oasis_1", x), _is("chroasis_oasis_1", 0) & (cell.value(x) > 0), sql.lit(False), text(f"Marked as having no anxiety in chroasis_oasis_1, but {x} is equal to ", col(x)), forms=("oasis",), reports=("Secondary Report",)))
    for x, cut in {"chroasis_oasis_4": 1, "chroasis_oasis_5": 0}.items():
        little = cell.value("chroasis_oasis_3") < 2
        out.append(implies(f"lifestyle {x}", ("chroasis_oasis_1", "chroasis_oasis_3", x), little & (cell.value(x) > cut), sql.lit(False), f"chroasis_oasis_1 states that lifestyle was not affected, but {x} is greater than {cut}", forms=("oasis",), reports=("Secondary Report",)))
    for life, recent in CSSRS_YES.items():
        out.append(implies(f"lifetime {life}", (life, recent), _is(life, 2) & _is(recent, 1), sql.lit(False), f"{recent} is yes, although {life}, which covers all times, is no.", forms=("cssrs_baseline",), reports=MAIN_AND_REST))
    for life, recent in CSSRS_COUNTS.items():
        out.append(Rule(f"count {life}", (life, recent), cell.value(life) < cell.value(recent), text(f"Lifetime variable ({life} = ", col(life), f") has lower intensity, than recent variable ({recent} = ", col(recent), ")."), ("cssrs_baseline",), MAIN_AND_REST))
    for stem, form in {"chrgfs_gf_social": "global_functioning_social_scale", "chrgfr_gf_role": "global_functioning_role_scale"}.items():
        scale = f"{stem}_scale" if "social" in stem else f"{stem}_scole"
        out += [extreme(f"{stem}_low", (scale, f"{stem}_high"), form, lowest=True), extreme(f"{stem}_high", (scale, f"{stem}_low"), form, lowest=False)]
    subject, parent, source = "chrtbi_subject_head_injury", "chrtbi_parent_headinjury", "chrtbi_sourceinfo"
    tbi = (parent, subject, source)
    out.append(Rule("head injury", tbi, _is(source, 3) & (cell.value(subject) != cell.value(parent)), sql.lit("The two informants disagree on head injuries."), ("traumatic_brain_injury_screen",), MAIN_AND_REST))
    out.append(Rule("informants", tbi, _is(source, 1, 2) & _is(subject, 0, 1) & _is(parent, 0, 1), sql.lit("Both informants have answers, but only one is marked as the source."), ("traumatic_brain_injury_screen",), ("Secondary Report",)))
    for item, low in {"somc": (1, 2, 3), "guil": (1, 2, 3), "gran": (1, 2, 3), "susp": (1,)}.items():
        x, unusual = f"chrbprs_bprs_{item}", "chrbprs_bprs_unus"
        out.append(Rule(f"{item} and unusual", (x, unusual), _is(x, 6, 7) & _is(unusual, *low), text(f"{x} is ", col(x), f", but {unusual} is ", col(unusual)), ("bprs",), exclusions=False))
    out.append(Rule("weight", ("chrchs_weightkg",), cell.num("chrchs_weightkg") < 0, text("chrchs_weightkg is ", col("chrchs_weightkg")), ("bprs",)))
    for limits, above, report in ((CONVERTS_ABOVE, True, "Main Report"), (CONVERTS_AT, False, "Conversion Report")):
        for x, t in limits.items():
            met = cell.num(x) > t if above else cell.num(x) == t
            form = "bprs" if "bprs" in x else "psychs_p1p8_fu" if "psychs" in x else SCID
            out.append(Rule(f"conversion {x}", (x,), met & (col("visit_status_string") != "converted"), text(f"{x} is ", col(x), ", but participant is not marked as converted."), (form,), (report,)))
    one, three = "chrpas_pmod_adult3v1", "chrpas_pmod_adult3v3"
    out.append(Rule("marriage", (three, one), _is(one, *range(4)) & _is(three, *range(7)), text(f"{one} is equal to ", col(one), f", but {three} is equal to ", col(three)), ("premorbid_adjustment_scale",), exclusions=False))
    for x in ("f", "m"):
        born, age = f"chrpps_{x}dob", f"chrpps_{x}age"
        years = v.years_between(cell.real_date(born, True), cell.real_date("chrpps_interview_date", True))
        out.append(Rule(f"birth {x}", ("chrpps_interview_date", born), (years < 10) | (years > 85), text(f"{born} implies an age of ", sql.rounded(years, 1)), ("psychosis_polyrisk_score",)))
        for source in (age, "demographics_age"):
            name = f"age {x}" if source == age else f"demographic age {x}"
            out.append(Rule(name, ("chrpps_interview_date", born, source), years - cell.value(source) >= 1, text(f"{source} (", col(source), ") is lower than the birth date implies"), ("psychosis_polyrisk_score",), exclusions=False))
    for names, low, high in ((PARENT_AGES, 10, 85), (ONSET_AGES, 0, 0)):
        for x in names:
            apart = sql.rounded(sql.absolute(cell.num("age") - cell.value(x)), 2)
            form = PARENT_FORMS.get(x.split("_")[0], SCID)
            out.append(Rule(f"age difference {x}", (x,), (apart < low) | (apart > high), text(f"{x} (", col(x), ") and the subject's age differ by ", apart), (form,)))
    return out


def extreme(score: str, others: tuple[str, ...], form: str, lowest: bool) -> Rule:
    """A "lowest" score lies above another, or a "highest" below."""
    values = [cell.value(x) for x in others]
    bound = sql.least(*values) if lowest else sql.greatest(*values)
    hit = cell.value(score) > bound if lowest else cell.value(score) < bound
    return Rule(f"extreme {score}", (score, *others), hit, text(f"{score} (", col(score), ") is not the ", "lowest" if lowest else "highest", " score"), (form,), MAIN_AND_REST)


def medication_slots(columns: list[str], field: str = "name") -> list[tuple[int, str]]:
    """(number, suffix) of the slots, current and past, of which the rows or the dictionary have this field."""
    found = [re.fullmatch(rf"chrpharm_med(\d+)_{field}(_past|)", x) for x in columns]
    return sorted({(int(m[1]), m[2]) for m in found if m}, key=lambda s: (s[1], s[0]))


def medication_rules(columns: list[str]) -> list[Rule]:
    """R28, R32, R33 of the medication forms, over all slots that the columns (of the rows, or the dictionary's variables) have."""
    out = []
    first, dose = "chrpharm_med1_onset", "chrpharm_firstdose_med1"
    a, b = (sql.split_part(col(x), " ", 1) for x in (first, dose))
    out.append(Rule("first dose", (first, dose), ~cell.is_empty(a) & ~cell.is_empty(b) & (a != b), text(f"{first} (", a, f") does not equal {dose} (", b, ")"), CURRENT_MEDICATION, gated=False))
    for n, past in medication_slots(columns, "onset"):
        on, off = f"chrpharm_med{n}_onset{past}", f"chrpharm_med{n}_offset{past}"
        if off in columns:
            out.append(ordered(f"onset {n}{past}", on, off, lambda x: cell.real_date(x, True), forms=_medication(past), gated=False))
    for n, past in medication_slots(columns):
        name = f"chrpharm_med{n}_name{past}"
        out.append(Rule(f"medication {n}{past}", (name,), cell.code_in(name, SPECIAL_MEDICATIONS), text(f"{name} has the value ", col(name)), _medication(past), gated=False))
    return out


def _medication(past: str) -> tuple[str, ...]:
    return PAST_MEDICATION if past else CURRENT_MEDICATION


def latest_onset(columns: list[str], slots: int = 10) -> list[Rule]:
    """R27 over the onset columns that the rows have."""
    onsets = [x for n in range(slots) if (x := f"chrpharm_med{n}_onset") in columns]
    if not onsets:
        return []
    latest = sql.array_max(sql.array(*[cell.real_date(x) for x in onsets]))
    days = v.days_between(latest, cell.real_date("chrpharm_date_mod"))
    return [Rule("latest onset", ("chrpharm_date_mod",), days > 10, text("There are ", days, " days between the most recent medication date (", latest, ") and the modification date"), CURRENT_MEDICATION, gated=False)]


def unknown_names(columns: list[str]) -> list[Rule]:
    """Slots whose name is 888 (unknown) while other fields are filled, in one flag for current and one for past medication."""
    return [*_unknown_names(columns, ""), *_unknown_names(columns, "_past")]


def _unknown_names(columns: list[str], past: str) -> list[Rule]:
    """The flag names the unknown names, then the fields that are filled."""
    names, others = [], []
    for n, suffix in medication_slots(columns):
        fields = [x for f in SLOT_FIELDS if (x := f"chrpharm_{f.format(n=n)}{past}") in columns]
        if suffix == past and fields:
            name = f"chrpharm_med{n}_name{past}"
            unknown = cell.is_code(name, 888)
            names.append(sql.when(unknown & any_of(map(cell.filled, fields)), sql.lit(name)))
            others += [sql.when(unknown & cell.filled(x), sql.lit(x)) for x in fields]
    if not names:
        return []
    given = lambda cells: sql.present(sql.array(*cells))
    unknown, filled = given(names), sql.array_distinct(given(others))
    message = text("Unknown (888) by ", sql.array_join(unknown, ", "), ", but filled: ", sql.array_join(filled, ", "))
    return [Rule(f"unknown{past.replace('_', ' ')} medication", (), sql.size(unknown) > 0, message, _medication(past), gated=False, named=sql.concat(unknown, filled))]


def overlapping_medications(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of slots of a row with one name and overlapping spans, unless one is of use 1 and the other of use 2.

    (keys, name, slot_1, slot_2); a slot's span runs from its onset to its last use, both real dates.
    """
    numbers = [int(m[1]) for x in rows.columns if (m := re.fullmatch(r"chrpharm_med(\d+)_name", x))]
    fields = {"name": "chrpharm_med{n}_name", "begun": "chrpharm_med{n}_onset", "ended": "chrpharm_lastuse_med{n}", "use": "chrpharm_med{n}_use"}
    filled = slots(rows, keys, max(numbers, default=0), fields).withColumns({x: v.real_date(x, True) for x in ("begun", "ended")})
    filled = filled.where("begun is not null and ended is not null").withColumnRenamed("name", "medication")
    pairs = overlapping(filled, [*keys, "medication"], "begun", "ended", "slot")
    uses = filled.select(*keys, "slot", v.num("use").alias("use"))
    for side in ("1", "2"):
        own = uses.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("slot").alias(f"slot_{side}"), F.col("use").alias(f"use_{side}"))
        pairs = pairs.join(own, [*[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], pairs[f"slot_{side}"] == own[f"slot_{side}"]]).drop(*[f"_{k}" for k in keys], own[f"slot_{side}"])
    shared = F.coalesce((F.least("use_1", "use_2") == 1) & (F.greatest("use_1", "use_2") == 2), F.lit(False))
    return pairs.where(~shared).select(*keys, F.col("medication").alias("name"), "slot_1", "slot_2")


def scid_rules(diagnoses: dict[str, dict] | None = None) -> list[Rule]:
    """R39-R50; diagnoses: variable -> {"criteria": names, "disorder": text, "extra": SQL conditions, "variables": those of the conditions}."""
    three = lambda x: _is(f"chrscid_{x}", 3)
    names = lambda *x: tuple(f"chrscid_{y}" for y in x)
    made = lambda name, variables, fires, message, **more: Rule(name, names(*variables), fires, sql.lit(message) if isinstance(message, str) else message, (SCID,), SCID_REPORTS, **more)
    out = []
    for variable, d in (diagnoses or {}).items():
        met = all_of([*(_is(x, 3) for x in d["criteria"]), *(sql.coalesce(sql.expr(e), False) for e in d.get("extra", ()))])
        both = (*d["criteria"], variable, *d.get("variables", ()))
        out.append(Rule(f"diagnosis {variable}", both, met & ~_is(variable, 3), sql.lit(f"All criteria of {d['disorder']} hold, but the diagnosis isn't given."), (SCID,), SCID_REPORTS, exclusions=False))
        out.append(Rule(f"no diagnosis {variable}", both, ~met & _is(variable, 3), sql.lit(f"{d['disorder']} is diagnosed without all of its criteria."), (SCID,), SCID_REPORTS, exclusions=False))
    ones = all_of(_is(x, 1) for x in names("a54", "a92", "a132"))
    out.append(made("depressive manic", ("d28", "d26", "d27", "a54", "a92", "a132"), ones & three("d26") & three("d27") & ~three("d28"), "Depression is ruled out by mania, but no manic or hypomanic screening item is positive.", exclusions=False))
    for kind, (a, b), d, more in (("major depressive", ("a25", "a51"), "d26", ("d3", "d9", "d11", "d23")), ("manic", ("a70", "a108"), "d2", ()), ("hypomanic", ("a91", "a129"), "d5", ())):
        episode = three(a) | three(b)
        wrong = (~episode & three(d)) | (episode & ~any_of(three(x) for x in more) & ~three(d))
        message = text(f"The {kind} episode items and their summary disagree (", *[p for x in (a, b, d) for p in (f" chrscid_{x} = ", col(f"chrscid_{x}"))], ")")
        out.append(made(f"{kind} episode", (a, b, d, *more), wrong, message, exclusions=False))
    manic = any_of(three(x) for x in ("a70", "a91", "a108", "a129", "a138"))
    out.append(made("mania not fulfilled", ("d28", "a70", "a91", "a108", "a129", "a138"), ~manic & ~three("d28"), "Without a manic or hypomanic episode chrscid_d28 is expected to be 3.", exclusions=False, applies=("chrscid_d28",)))
    a, b, count = three("a27"), three("a28"), "chrscid_a48_1"
    below = lambda x: _is(f"chrscid_{x}", 1, 2)
    both = a & b & ~_is(count, 2)
    one = (a & below("a28")) | (b & below("a27") & ~_is(count, 1))
    out.append(made("depressed mood", ("a27", "a28", "a48_1"), both | one, sql.when(both, "Both main criteria hold, but the counter a48_1 isn't 2").otherwise("One of the main criteria a27 and a28 holds, but the other one and the counter a48_1 don't fit")))
    n, episode = cell.value("chrscid_a26_53"), three("a25") | three("a51")
    out.append(made("episode count", ("a26_53", "a25", "a51"), ((n < 1) & episode) | ((n > 0) & ~episode), sql.when(episode, "A depressive episode is present, but the lifetime count a26_53 is below 1").otherwise("The lifetime count a26_53 is above 0, but no depressive episode is present")))
    for kind, x, y, e in (("", "a1", "a2", "a25"), ("past ", "a27", "a28", "a51")):
        out.append(made(f"{kind}threshold", (x, y, e), ~three(x) & ~three(y) & three(e), f"A {kind}major depressive episode is marked, but neither of its main criteria reaches the threshold."))
    moods = ("a25", "a51", "a70", "a91", "a108", "a129", "a138", "a153", "a170")
    out.append(made("mood symptoms", ("d1", "c26", *moods), any_of(three(x) for x in moods) & ~three("c26") & ~_is("chrscid_d1", 1), "There are mood symptoms, but chrscid_d1 isn't marked."))
    asked = (cell.value("chrscid_a22") > 4) & (cell.value("chrscid_a22_1") > 0) & cell.is_empty("chrscid_a25")
    out.append(made("mood episode", ("a25", "a22", "a22_1"), asked, "More than four criteria of depression (a22, a22_1), but a25 is unanswered"))
    return out


def general_rules(run_age: tuple[float, float] = (12, 30), identifiers: tuple[str, ...] = ("chrguid_guid", "chrguid_pseudoguid")) -> list[Rule]:
    """R5, R7 for the identifier variables, each judged by its own text, and the subject's age."""
    low, high = run_age
    out = [pattern(f"identifier {x}", x, "^NDA[A-Z0-9]+$", "Not an identifier's format", forms=("guid_form",), reports=MAIN_AND_REST, applies=(x,), withdrawn=True) for x in identifiers]
    return [*out, Rule("age", ("age",), (col("age") == "unknown") | (cell.num("age") < low) | (cell.num("age") > high), text("Age is ", col("age")), gated=False)]


def missing_reason(flag: str, reason: str, form: str) -> Rule:
    """A form is marked missing without a reason."""
    return Rule(f"reason {form}", (flag, reason), cell.is_code(flag, 1) & cell.is_blank(reason), sql.lit("Form is marked as missing, but no reason is given."), (form,), gated=False)


def within_21_days(forms: dict[str, str], marker: str, screen_date: str = "psychs_screen_date") -> list[Rule]:
    """A reason M6, but a form's date lies over 21 days from the screening date; forms: form -> date variable."""
    out = []
    for form, x in forms.items():
        if form not in EXEMPT_FROM_21_DAYS:
            days = v.days_between(cell.real_date(x), cell.real_date(screen_date))
            message = text(f"Reason M6, but {form} (", col(x), ") lies over 21 days from the screening interview (", col(screen_date), ")")
            out.append(Rule(f"21 days {form}", (marker, x), (col(marker) == "M6") & (days > 21), message, (form,), MAIN_AND_REST, gated=False))
    return out


__all__ = [
    "blood_rules", "clinical_rules", "extreme", "general_rules", "latest_onset", "medication_rules", "medication_slots", "missing_reason", "outside", "overlapping_medications", "scid_rules", "unknown_names", "within_21_days",
]

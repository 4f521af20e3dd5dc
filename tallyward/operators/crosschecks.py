"""Checks that bring a row together with another table or another timepoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as v
from tallyward.functions.expressions import col
from tallyward.functions.values import of_text as cell
from tallyward.operators.rules import Rule, text

# The parents' ages of two forms, by variable and timepoint, and the kinds of intelligence tests.
PARENT_AGES = {"chrpps_mage_baseline": "chrfigs_mother_age_screening", "chrpps_fage_baseline": "chrfigs_father_age_screening"}
ASSESSMENTS = (1, 2)


def unrecorded_conversions(rows: DataFrame, conversions: DataFrame, date: str = "chrconv_interview_date") -> DataFrame:
    """Rows of subjects that a status file names as converted, without a date in the conversion form; conversions: (subject, conversion_date)."""
    converted = conversions.where("conversion_date is not null").select(F.col("subject").alias("subjectid")).distinct()
    found = rows.where(v.is_empty(date)).join(converted, "subjectid", "left_semi")
    return found.withColumn("error_message", F.lit("Subject converted, but date not filled out in conversion form."))


def parents(rows: DataFrame, keys: list[str], pairs: dict[str, str] = PARENT_AGES) -> DataFrame | None:
    """A row for each subject with a baseline row: its keys and _ok there, and the cells that R52 compares; None where the rows lack them."""
    cells = {x: x.rsplit("_", 1) for pair in pairs.items() for x in pair}
    known = set(rows.columns)
    if not any(cells[a][0] in known and cells[b][0] in known for a, b in pairs.items()):
        return None
    at = lambda x, t: F.first(F.when(F.col("timepoint") == t, F.col(x)), ignorenulls=True)
    made = [at(x, t).alias(name) for name, (x, t) in cells.items() if x in known]
    wide = rows.where(F.col("timepoint").isin(*sorted({t for _, t in cells.values()})))
    kept = [F.first(F.when(F.col("timepoint") == "baseline", F.struct(*keys)), ignorenulls=True).alias("_own"), F.array_distinct(F.flatten(F.collect_list("_ok"))).alias("_ok")]
    return wide.groupBy("subjectid").agg(*kept, *made).drop("subjectid").where("_own is not null").select("_own.*", "_ok", *[c for c in cells if cells[c][0] in known])


def differing_ages(pairs: dict[str, str] = PARENT_AGES) -> list[Rule]:
    """A parent's age differs between two forms of different timepoints; rules for rows of `model.wide_subjects`."""
    out = []
    for a, b in pairs.items():
        differs = cell.value(a) != cell.value(b)
        out.append(Rule(f"ages {a}", (a, b), differs, text(f"{b} is equal to ", col(b), f", but {a} is equal to ", col(a)), ("family_interview_for_genetic_studies_figs", "psychosis_polyrisk_score")))
    return out


def carried_flags(rows: DataFrame, legacy: DataFrame, form: str = "IQ Assessment Wasii", word: str = "Conversion") -> DataFrame:
    """Flags of an old tracker, of one form and with a word in them, for the rows of the same subject and timepoint.

    legacy: (subject, timepoint, general_flag, specific_flags), the latter separated by |.
    """
    old = legacy.where(F.col("general_flag").contains(form)).withColumn("timepoint", v.timepoint_alias("timepoint"))
    old = old.select(F.col("subject").alias("subjectid"), "timepoint", F.explode(F.split("specific_flags", r"\|")).alias("error_message"))
    return rows.join(old.where(F.col("error_message").contains(word)).withColumn("error_message", F.trim("error_message")), ["subjectid", "timepoint"])


def age_at_test(age: str = "age", known_on: str = "demographics_date", tested_on: str = "chriq_interview_date") -> Column:
    """The age at a test, from an earlier age and the days since."""
    return v.num(age) + v.days_between(v.real_date(known_on), v.real_date(tested_on)) / 365


def assessment(x: str = "chriq_assessment") -> Column:
    """The kind of test, if it is a known one."""
    return F.when(v.code_in(x, ASSESSMENTS), v.num(x).cast("int"))

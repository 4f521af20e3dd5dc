"""The data model: timepoints, networks, cohorts, and the subject table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.functions import values as v

# The ordered visits and the two without an order.
TIMEPOINTS = ("screening", "baseline", *(f"month{n}" for n in range(1, 13)), "month18", "month24")
UNORDERED = ("floating", "conversion")
COHORTS = {1: "CHR", 2: "HC"}
INCLUSION = {1: "included", 0: "excluded"}
SEXES = {1: "Male", 2: "Female"}


def month_of(timepoint: str) -> int:
    return int(timepoint.removeprefix("month")) if timepoint.startswith("month") else 0 if timepoint == "screening" else 1


def timepoints(spark: SparkSession) -> DataFrame:
    """(timepoint, ordinal, previous, following): a small dimension; unordered visits have no ordinal."""
    rows = [(t, i) for i, t in enumerate(TIMEPOINTS)] + [(t, None) for t in UNORDERED]
    return spark.createDataFrame(with_neighbours(rows), "timepoint string, ordinal int, previous string, following string")


def with_neighbours(rows: list[tuple[str, int | None]]) -> list[tuple]:
    order = [t for t, i in rows if i is not None]
    return [(t, i, order[i - 1] if i else None, order[i + 1] if i is not None and i + 1 < len(order) else None) if i is not None else (t, None, None, None) for t, i in rows]


def neighbours(visits: DataFrame, key: str, ordinal: str, *columns: str) -> DataFrame:
    """Each visit with the named columns of the one before it."""
    w = Window.partitionBy(key).orderBy(ordinal)
    return visits.withColumns({f"previous_{x}": F.lag(x).over(w) for x in columns})


def site_of(subject: str = "subjectid") -> Column:
    return F.substring(subject, 1, 2)


def label(codes: dict, x: str) -> Column:
    """P5: a code's label, else unknown."""
    out = F.lit("unknown")
    for code, name in codes.items():
        out = F.when(v.is_code(x, code), name).otherwise(out)
    return out


def age_in_years(*months: str) -> Column:
    """The first usable of several ages in months, in years; unknown where none is an unsigned number."""
    usable = [F.when(v.filled(m) & F.col(m).rlike(r"^[0-9]+(\.[0-9]+)?$"), F.round(v.num(m) / 12, 2)) for m in months]
    return F.coalesce(*[u.cast("string") for u in usable], F.lit("unknown"))


def subject_info(screening: DataFrame, baseline: DataFrame, floating: DataFrame) -> DataFrame:
    """One row for each subject, every field from its one source snapshot."""
    a = screening.select(
        F.col("subjectid").alias("subject"), label(INCLUSION, "chrcrit_included").alias("inclusion_status"), label(COHORTS, "chrcrit_part").alias("cohort"), F.col("visit_status_string").alias("visit_status"),
        F.col("chrpsychs_scr_interview_date").alias("psychs_screen_date"), F.col("chric_actigraphy").alias("axivity_opt"), F.col("chric_passive").alias("mindlamp_opt"),
    )
    age = age_in_years("chrdemo_age_mos_chr", "chrdemo_age_mos_hc", "chrdemo_age_mos2")
    b = baseline.select(F.col("subjectid").alias("subject"), label(SEXES, "chrdemo_sexassigned").alias("sex"), age.alias("age"), F.col("chrdemo_interview_date").alias("demographics_date"))
    f = floating.select(F.col("subjectid").alias("subject"), v.is_code("chr_statusform_screenfail", 1).alias("screenfail"), v.is_code("chr_subject_eos", 1).alias("completed_study"))
    return a.join(b, "subject", "full").join(f, "subject", "full")


def wide_subjects(long: DataFrame, variables: list[str], domain=TIMEPOINTS) -> DataFrame:
    """One row for each subject, columns variable_timepoint, by one pivot instead of a chain of joins."""
    return long.groupBy("subjectid").pivot("timepoint", list(domain)).agg(*[F.first(x, ignorenulls=True).alias(x) for x in variables])


def merged_generations(first: DataFrame, second: DataFrame, part: str, suffixes: tuple[str, str] = ("_baseln", "_month2"), key: str = "subjectid") -> DataFrame:
    """Two generations of snapshots side by side, a row for each subject of either (null subjects meet too).

    The first one's columns with `part` in their names stay; those that the second has as well come from both, with a suffix for each.
    """
    own = [x for x in first.columns if part in x]
    both = [x for x in own if x in second.columns]
    a = first.select(key, *[F.col(x).alias(x + suffixes[0] if x in both else x) for x in own])
    b = second.select(F.col(key).alias("_key"), *[F.col(x).alias(x + suffixes[1]) for x in both])
    joined = a.join(b, a[key].eqNullSafe(b["_key"]), "full")
    return joined.select(F.coalesce(key, "_key").alias(key), *[x for x in joined.columns if x not in (key, "_key")])

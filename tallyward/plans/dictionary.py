"""Tables derived from the data dictionary: forms, special variables, variable groups, rule lists, reports.

The dictionary has a row for each variable: variable, form, field_type, label, choices, branching_logic, required, identifier, validation, validation_min, validation_max.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import predicates
from tallyward.functions import values as v

# Ranges that no dictionary needs to state.
FIXED_RANGES = {
    "chrpps_mage": (10, 85), "chrpps_fage": (10, 85), "chrfigs_mother_age": (10, 85), "chrfigs_father_age": (10, 85), "chrpreiq_standard_score": (70, 130), "chriq_fsiq": (70, 130),
}
PSYCHS_ITEMS = 15


def any_text(column: str | Column, texts: list[str]) -> Column:
    """the column contains any of the texts."""
    return F.coalesce(v.c(column).rlike("|".join(re.escape(t) for t in texts)), F.lit(False)) if texts else F.lit(False)


def forms_of(dictionary: DataFrame) -> DataFrame:
    """P8."""
    return dictionary.select("variable", "form")


def labels(dictionary: DataFrame) -> DataFrame:
    """Readable labels without tags; a blank label falls back to the choices."""
    own = v.strip_tags("label")
    return dictionary.select("variable", F.when(F.trim(own) != "", own).otherwise(v.strip_tags("choices")).alias("label"))


def special_variables(dictionary: DataFrame, kinds: list[tuple[str, str, list[str]]]) -> DataFrame:
    """P10: (form, kind, variable, position) of variables whose column holds one of a kind's texts; names with err or invalid are no candidates."""
    clean = dictionary.where(~F.col("variable").rlike("err|invalid"))
    out = None
    for position, (kind, column, texts) in enumerate(kinds):
        part = clean.where(any_text(column, texts)).select("form", F.lit(kind).alias("kind"), "variable", F.lit(position).alias("position"))
        out = part if out is None else out.unionByName(part)
    return out


def form_metadata(special: DataFrame, kinds: list[str], always: DataFrame) -> DataFrame:
    """One row for each form, the last candidate of each kind, the completion variable, and the always-shown variables."""
    last = special.groupBy("form").pivot("kind", kinds).agg(F.max_by("variable", F.struct("position", "variable")))
    return last.join(always, "form", "left").withColumn("completion_var", F.concat("form", F.lit("_complete")))


def always_shown(dictionary: DataFrame) -> DataFrame:
    """By form, variables without branching logic that aren't identifiers, checkboxes, notes or descriptions."""
    rows = dictionary.where((F.col("branching_logic") == "") & (F.col("identifier") != "y") & ~F.col("field_type").isin("checkbox", "notes", "descriptive"))
    return rows.groupBy("form").agg(F.array_sort(F.collect_list("variable")).alias("non_branch_logic_vars"))


def grouped(dictionary: DataFrame, patterns: dict[str, str], where: Column | None = None) -> DataFrame:
    """(grp, variable) for groups given by name patterns."""
    rows = dictionary if where is None else dictionary.where(where)
    tagged = F.filter(F.array(*[F.when(F.col("variable").rlike(p), g) for g, p in patterns.items()]), lambda x: x.isNotNull())
    return rows.select(F.explode(tagged).alias("grp"), "variable")


def ranges(dictionary: DataFrame, fixed: dict[str, tuple[float, float]] = FIXED_RANGES) -> DataFrame:
    """(variable, low, high); the dictionary's limits win where both are numbers, missing codes in them count as 0."""
    limit = lambda x: F.when(v.is_missing(x), F.lit(0.0)).otherwise(v.num(x))
    own = dictionary.select("variable", limit("validation_min").alias("own_low"), limit("validation_max").alias("own_high")).where("own_low is not null and own_high is not null")
    base = dictionary.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in fixed.items()], "variable string, low double, high double")
    return base.join(own, "variable", "full").select("variable", F.coalesce("own_low", "low").alias("low"), F.coalesce("own_high", "high").alias("high"))


def blank_check_variables(dictionary: DataFrame, secondary_forms: list[str], extra: list[str] = ()) -> DataFrame:
    """(variable, form, report) of variables that must not be blank."""
    must = (F.col("required") == "y") & (F.col("field_type") != "checkbox") & (F.col("identifier") != "y") & ~F.col("form").contains("psychs")
    rows = dictionary.where(must | F.col("variable").isin(*extra) if extra else must)
    secondary = (F.col("field_type") == "notes") | F.col("form").isin(*secondary_forms)
    return rows.select("variable", "form", F.when(secondary, "Secondary Report").otherwise("Main Report").alias("report"))


def missing_code_variables(dictionary: DataFrame, networks: dict[str, list[str]]) -> DataFrame:
    """(network, variable) of variables checked for missing codes, by the forms of each network."""
    out = None
    for network, forms in networks.items():
        part = dictionary.where(F.col("form").isin(*forms)).select(F.lit(network).alias("network"), "variable")
        out = part if out is None else out.unionByName(part)
    return out


def required_checkboxes(dictionary: DataFrame) -> DataFrame:
    """P19."""
    return dictionary.where((F.col("field_type") == "checkbox") & (F.col("required") == "y")).select("variable")


def excluded_variables(dictionary: DataFrame, texts: dict[str, list[str]], added: DataFrame | None = None) -> DataFrame:
    """P20: (network, variable) of variables whose name contains one of a network's texts, and of newly added ones."""
    out = None
    for network, names in texts.items():
        part = dictionary.where(any_text("variable", names)).select(F.lit(network).alias("network"), "variable")
        if added is not None:
            part = part.unionByName(added.select(F.lit(network).alias("network"), "variable"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def generated_names(spark, prefix: str, letters: str, numbers: range, items: int = PSYCHS_ITEMS) -> DataFrame:
    """Prefix, item, letter and number in all combinations, from sequences."""
    base = spark.range(1, items + 1).select(F.col("id").alias("item"))
    base = base.select("item", F.explode(F.array(*map(F.lit, letters))).alias("letter"))
    base = base.withColumn("number", F.explode(F.sequence(F.lit(numbers.start), F.lit(numbers.stop - 1))))
    return base.select(F.concat(F.lit(prefix), F.col("item").cast("string"), "letter", F.col("number").cast("string")).alias("variable"))


def team_forms(dictionary: DataFrame, teams: dict[str, list[str]], rest: str = "Non Team Forms", always: tuple[str, ...] = ()) -> DataFrame:
    """(report, form); forms of no team, and those in `always`, go to the rest."""
    spark = dictionary.sparkSession
    listed = spark.createDataFrame([(t, f) for t, forms in teams.items() for f in forms], "report string, form string")
    forms = dictionary.select("form").distinct()
    others = forms.join(listed.select("form").distinct(), "form", "left_anti").unionByName(forms.where(F.col("form").isin(*always)) if always else forms.where("false"))
    return listed.unionByName(others.distinct().select(F.lit(rest).alias("report"), "form"))


def identifier_effects(dictionary: DataFrame) -> DataFrame:
    """(variable, affected_col, identifier) of variables whose calculation or branching logic mentions an identifier."""
    identifiers = dictionary.where("identifier = 'y'").select(F.col("variable").alias("identifier"))
    texts = dictionary.select("variable", "branching_logic", "choices").unpivot("variable", ["branching_logic", "choices"], "affected_col", "text")
    return texts.select("variable", "affected_col", F.explode(predicates.mentioned(F.col("text"))).alias("identifier")).join(identifiers, "identifier", "left_semi").select("variable", "affected_col", "identifier")


def unsupported(dictionary: DataFrame) -> DataFrame:
    """(variable, reason) of variables whose predicate can't be used: parts that no pattern covers, or identifiers in it."""
    left = predicates.compiled(dictionary).where("rest != ''").select("variable", F.lit("pattern").alias("reason"))
    named = identifier_effects(dictionary).where("affected_col = 'branching_logic'").select("variable", F.lit("identifier").alias("reason")).distinct()
    return left.unionByName(named)

"""Applicability predicates of a data dictionary, rewritten as Spark SQL.

`[item]='1'` and its kin become boolean SQL over text columns that is never null: a column that a file doesn't have counts as absent.
The rewrite is one chain of regexp_replace over the whole dictionary; the results feed `F.expr`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions.expressions import Sql

_IS_NUMBER = "[ \t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t]*"
_NAME = r"\[([A-Za-z]\w*)\]"
_OP = r"\s*(<=|>=|<>|!=|=|<|>)\s*"


def _number_of(group: str) -> str:
    return f"try_cast(CASE WHEN `{group}` RLIKE '^{_IS_NUMBER}@' THEN trim(`{group}`) END AS DOUBLE)".replace("@", r"\$")


def _steps() -> list[tuple[str, str]]:
    """(pattern, replacement) in Java's syntax; later ones see what earlier ones left."""
    n1, n2 = _number_of("$1"), _number_of("$2")
    out = [(r"\[(\w+)\((\w+)\)\]", "[$1___$2]"), (r"\[\w+\]\[(\w+)\]", "[$1]"), (r'"', "'")]
    # '00' is a text of its own
    out += [(_NAME + r"\s*=\s*'(00)'", "coalesce(`$1` = '00', false)"), (_NAME + r"\s*(?:<>|!=)\s*'(00)'", "coalesce(`$1` != '00', true)")]
    out += [(_NAME + r"\s*=\s*''", "coalesce(`$1` = '', true)"), (_NAME + r"\s*(?:<>|!=)\s*''", "coalesce(`$1` != '', false)")]
    literal = r"'?(-?\d+(?:\.\d+)?)'?"
    out.append((_NAME + r"\s*(?:<>|!=)\s*" + literal, f"coalesce({n1} != $2, true)"))
    for op in ("<=", ">=", "=", "<", ">"):
        out.append((_NAME + rf"\s*{op}\s*" + literal, f"coalesce({n1} {op} $2, false)"))
    both = r"\s*{}\s*" + _NAME
    out.append((_NAME + both.format("="), f"(coalesce({n1} = {n2} OR `$1` = `$2`, false) OR (`$1` IS NULL AND `$2` IS NULL))"))
    unequal = f"coalesce(CASE WHEN `$1` IS NULL THEN `$2` != '' WHEN `$2` IS NULL THEN `$1` != '' WHEN {n1} IS NOT NULL AND {n2} IS NOT NULL THEN {n1} != {n2} WHEN {n1} IS NULL AND {n2} IS NULL THEN `$1` != `$2` END, false)"
    out.append((_NAME + both.format("(?:<>|!=)"), unequal))
    for op in ("<=", ">=", "<", ">"):
        out.append((_NAME + both.format(op), f"coalesce({n1} {op} {n2}, false)"))
    return out


def rewritten(logic: Sql) -> Sql:
    """The SQL of a predicate text; blank stays blank (always applicable)."""
    for pattern, replacement in _steps():
        logic = sql.regexp_replace(logic, pattern, replacement)
    return sql.regexp_replace(logic, r"[\r\n]+", " ")


def leftover(logic: Sql) -> Sql:
    """What the supported forms leave of a predicate text; empty if all of it is covered."""
    logic = sql.regexp_replace(logic, r"\[(\w+)\((\w+)\)\]", "[$1___$2]")
    operand = r"(?:\[[A-Za-z]\w*\]|'-?\d*(?:\.\d+)?'|\"-?\d*(?:\.\d+)?\"|-?\d+(?:\.\d+)?)"
    logic = sql.regexp_replace(logic, r"\[[A-Za-z]\w*\]" + _OP.replace("(<=", "(?:<=") + operand, "")
    return sql.trim(sql.regexp_replace(sql.regexp_replace(logic, r"(?i)\b(and|or)\b", ""), r"[()\s]+", ""))


def mentioned(text: Column) -> Column:
    """The variables in square brackets."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[(\w+)\]"), F.lit(1)))


# Predicates of single variables.
_INJURED = "[chrtbi_parent_headinjury] ='1' or [chrtbi_subject_head_injury] ='1'"
OWN_LOGIC = {
    "chrtbi_parent_headinjury": "[chrtbi_sourceinfo] = '3' or [chrtbi_sourceinfo] ='2'", "chrtbi_subject_head_injury": "[chrtbi_sourceinfo] ='3' or [chrtbi_sourceinfo] ='1'",
    "chrtbi_age_first_inj": _INJURED, "chrtbi_age_recent_inj": _INJURED, "chrtbi_number_injs": _INJURED,
    "chrpsychs_av_audio_expl": "[chrpsychs_av_audio_yn] = 0", "chrpsychs_av_qual_desc": "[chrpsychs_av_quality] = 0",
    "chrpsychs_av_dev_desc": "[chrpsychs_av_deviation] = 0", "chrpsychs_av_pause_reason": "[chrpsychs_av_pause_rec] = 1",
}
#: SCID texts that a ticked box replaces.
SCID_BOXES = {"chrscid_b48": "chrscid_b49", "chrscid_b53": "chrscid_b54", "chrscid_b58": "chrscid_b59", "chrscid_b63": "chrscid_b64"}


def edited(variable: Sql, logic: Sql) -> Sql:
    """P25: the predicate text that holds for a variable: head injuries, past medication, audio and video, SCID B45-B64, else its own."""
    own = sql.coalesce(*[sql.when(variable == x, sql.lit(text)) for x, text in OWN_LOGIC.items()])
    injuries = [
        sql.when(variable.contains("chrtbi") & variable.contains(n), sql.when(variable.contains("parent"), sql.lit(f"[chrtbi_number_injs] = '{n}' and [chrtbi_parent_times] = '3'")).otherwise(sql.lit(f"[chrtbi_number_injs] = '{n}' and [chrtbi_subject_times] = '3'")))
        for n in "45"
    ]
    n = sql.regexp_extract(variable, r"(\d+)", 1)
    before = sql.concat(sql.lit("chrpharm_med"), (n.try_cast("int") - 1).cast("string"), sql.lit("_add_past"))
    before = sql.when(n.isin("1", ""), sql.lit("chrpharm_med_past")).otherwise(before)
    past = sql.concat(sql.lit("[chrpharm_med"), n, sql.lit("_name_past] <> '999' and ["), before, sql.lit("] = '1'"))
    past = sql.when(variable.contains("chrpharm_med") & (variable.contains("onset_past") | variable.contains("offset_past")), past)
    three = " or ".join(f"[chrscid_b{k}] = 3" for k in (*range(1, 15), *range(16, 22), *range(26, 39)))
    three += " or ([chrscid_b40] = 3 and [chrscid_b41] = 3) or ([chrscid_b42] = 3 and [chrscid_b43] = 3)"
    with_own = sql.when(sql.trim(logic) == "", sql.lit("")).otherwise(sql.concat(sql.lit("("), logic, sql.lit(") and ")))
    boxes = sql.coalesce(*[sql.when(variable == x, sql.lit(f" and ([{box}(1)] <> 1)")) for x, box in SCID_BOXES.items()], sql.lit(""))
    scid = sql.when(variable.isin(*[f"chrscid_b{k}" for k in range(45, 65)]), sql.concat(with_own, sql.lit(f"({three})"), boxes))
    past_c = sql.when(variable == "chrscid_c56_c65", sql.concat(with_own, sql.lit("([chrscid_b23(1)] <> 1)")))
    return sql.coalesce(own, *injuries, past, scid, past_c, logic)


def _numeric(name: str) -> str:
    return _number_of(name).replace(r"\$", "$")


def manual() -> dict[str, str]:
    """P25: variables whose predicates are SQL from the start."""
    picture = f"coalesce({_numeric('chriq_assessment')} IN (4, 5), false)"
    is_ = lambda x, code: f"coalesce({_numeric(x)} = {code}, false)"
    ratio = f"coalesce(try_divide({_numeric('chrsofas_currscore')}, {_numeric('chrsofas_premorbid')}) >= 0.9D, false)"
    return {
        "chr_ae1date_dr": f"{is_('chrae_aescreen', 1)} AND {is_('chrae_dr1', 1)}",
        "chreeg_entry_date": "coalesce(`chreeg_interview_date` != '', false)",
        "chrpsychs_scr_e24": f"{is_('chrpsychs_scr_ac1', 0)} AND {is_('chrpsychs_scr_e4', 1)} AND {is_('chrpsychs_scr_e21', 0)} AND {ratio}",
        "chriq_pic_completion_raw": picture, "chriq_scaled_pic_completion": picture,
        "chrdig_notes_5": f"{is_('chrdig_reason_missing', 3)} AND coalesce(`chrdig_motivational` != '', false)",
    }


def compiled(dictionary: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(variable, predicate, rest): overrides (variable, predicate) win, then P25's own ones; a non-empty rest is not supported and excludes the variable."""
    logic = edited(sql.col("variable"), sql.coalesce(sql.col("branching_logic"), ""))
    own = sql.coalesce(*[sql.when(sql.col("variable") == x, text) for x, text in manual().items()])
    out = dictionary.selectExpr("variable", f"{logic.text} AS logic", f"{own.text} AS own")
    predicate, rest = sql.coalesce(sql.col("own"), rewritten(sql.col("logic"))), sql.when(sql.col("own").isNotNull(), "").otherwise(leftover(sql.col("logic")))
    out = out.selectExpr("variable", f"{predicate.text} AS predicate", f"{rest.text} AS rest")
    if overrides is None:
        return out
    own = overrides.select("variable", F.col("predicate").alias("own"))
    return out.join(own, "variable", "left").select("variable", F.coalesce("own", "predicate").alias("predicate"), F.when(F.col("own").isNotNull(), "").otherwise(F.col("rest")).alias("rest"))


def applicable(predicate: str, columns: Iterable[str]) -> Sql:
    """A compiled predicate over rows with these columns; names that no file has count as absent."""
    if not predicate.strip():
        return sql.lit(True)
    known = columns if isinstance(columns, (set, frozenset)) else set(columns)
    return sql.expr(re.sub(r"`(\w+)`", lambda m: m[0] if m[1] in known else "CAST(NULL AS STRING)", predicate))

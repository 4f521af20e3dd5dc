"""Who entered a value: the rater of each measured cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions.expressions import col
from tallyward.functions.values import of_text as cell
from tallyward.operators.gate import KEEPS_OWN_COMPLETION


def measured(rows: DataFrame, keys: list[str], forms: dict[str, str], users: dict[str, str], dates: dict[str, str], assigned: DataFrame | None = None, subject: str = "subjectid") -> DataFrame:
    """(keys, variable, form, value, form_date, rater): the numbers of a row with their form's date and the rater who entered them.

    forms: variable -> form; users and dates: form -> its user and interview date columns, as the dictionary names them (`Study.users`, `Study.interview_dates`); a
    form without one, or rows without its column, give a blank.  In the network that assigns subjects to raters a map (subject, rater) comes first and the form's user
    second; of several raters of a subject the first by name.  rows need a network.
    """
    known, cells = set(rows.columns), []
    for x, form in forms.items():
        if x in known:
            user, date = users.get(form), dates.get(form)
            rater = sql.coalesce(col(user).cast("string"), "") if user in known else sql.lit("")
            day = sql.coalesce(cell.clean_date_text(date), "") if date in known else sql.lit("")
            cells.append(f"named_struct('variable', {sql.text_of(x)}, 'form', {sql.text_of(form)}, 'value', {cell.num(x).text}, 'form_date', {day.text}, 'rater', {rater.text})")
    kept = list(dict.fromkeys([*keys, subject, "network"]))
    if not cells:
        return rows.where("false").selectExpr(*kept, "'' AS variable", "'' AS form", "0D AS value", "'' AS form_date", "'' AS rater")
    long = rows.select(*kept, F.expr(f"inline(filter(array({', '.join(cells)}), x -> x.value IS NOT NULL))"))
    if assigned is None:
        return long
    own = assigned.groupBy(F.col("subject").alias("_subject")).agg(F.min("rater").alias("_rater"))
    found = long.join(own, (F.col(subject) == F.col("_subject")) & (F.col("network") == KEEPS_OWN_COMPLETION), "left")
    return found.withColumn("rater", F.coalesce("_rater", "rater")).drop("_subject", "_rater")

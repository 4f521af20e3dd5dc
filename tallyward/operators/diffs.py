"""Differences between two generations of snapshots or trackers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as v


def changed_cells(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that changed, over common rows and columns; equal numbers in other spellings are no change.

    Both sides hold their cells as text.  Rows are joined once and compared column by column, so cells are only made rows where they differ.
    """
    common = [x for x in before.columns if x in after.columns and x not in keys]
    joined = before.alias("b").join(after.alias("a"), keys)
    cells = []
    for x in common:
        old, new = F.col(f"b.{x}").cast("string"), F.col(f"a.{x}").cast("string")
        same = old.eqNullSafe(new) | F.coalesce(v.num(old) == v.num(new), F.lit(False))
        cells.append(F.when(~same, F.struct(F.lit(x).alias("variable"), old.alias("before"), new.alias("after"))))
    changed = F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull()))
    return joined.select(*keys, changed.alias("c")).select(*keys, "c.*")


def column_changes(before: DataFrame, after: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Names (variable) that only one side has; with `wanted`, only those of it."""
    gone = before.select("variable").distinct().join(after, "variable", "left_anti").withColumn("change", F.lit("removed"))
    come = after.select("variable").distinct().join(before, "variable", "left_anti").withColumn("change", F.lit("added"))
    out = gone.unionByName(come)
    return out if wanted is None else out.join(wanted, "variable", "left_semi")


def new_variables(new: DataFrame, old: DataFrame) -> DataFrame:
    """J10."""
    return new.join(old, "variable", "left_anti")


def normal_form(x) -> Column:
    """Form names of the old tracker: trimmed, lower case, blanks as underscores."""
    return F.replace(F.lower(F.trim(v.c(x))), F.lit(" "), F.lit("_"))


def compared_trackers(old: DataFrame, new: DataFrame, keys: list[str], count: str = "flag_count") -> DataFrame:
    """The rows of two trackers side by side, with the side that has each."""
    o, n = old.select(*keys, F.col(count).alias("old_count")), new.select(*keys, F.col(count).alias("new_count"))
    side = F.when(F.col("old_count").isNull(), "new only").when(F.col("new_count").isNull(), "old only").otherwise("both")
    return o.join(n, keys, "full").withColumn("side", side)

"""Value classes of form cells.

Cells are text.  A number is what reads as one in whole, missing codes stand for "asked, no answer", and a blank is an empty text; a null is a
column that the row's file does not have.  All functions are total: under ANSI mode they never raise.

Each function takes a column's name, a column or a piece of SQL text (`functions.expressions`), and gives SQL text for SQL text, otherwise a column.
`of_text` has them all with names as SQL text, which is what rules are made of.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as columns

from tallyward.functions import expressions as F

# Codes and dates that mean "missing".
MISSING_NUMBERS = (-3, -9, -99, 999)
MISSING_DATES = ("1909-09-09", "1903-03-03", "1901-01-01")

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def c(name: str | Column) -> Column:
    return columns.col(name) if isinstance(name, str) else name


def num(x) -> Column:
    """The cell as a double; null where it isn't a finite number."""
    x = c(x).cast("string")
    return F.when(x.rlike(_NUMBER), F.trim(x).try_cast("double"))


def is_number(x) -> Column:
    return F.coalesce(c(x).rlike(_NUMBER), False)


def is_digits(x) -> Column:
    return F.coalesce(c(x).rlike("^[0-9]+$"), False)


def is_blank(x) -> Column:
    return F.coalesce(c(x).cast("string") == "", False)


def is_missing(x) -> Column:
    return F.coalesce(num(x).isin(*MISSING_NUMBERS), False) | F.coalesce(c(x).cast("string").isin(*MISSING_DATES), False)


def is_empty(x) -> Column:
    """Blank or a missing code."""
    return is_blank(x) | is_missing(x)


def filled(x) -> Column:
    """In the file, not blank, not a missing code."""
    return c(x).isNotNull() & ~is_empty(x)


def code_in(x, codes: Iterable[float]) -> Column:
    """The cell is one of these codes in any spelling."""
    return F.coalesce(num(x).isin(*[float(v) for v in codes]), False)


def is_code(x, code: float) -> Column:
    return code_in(x, [code])


def value(x) -> Column:
    """The number of a cell that holds one and isn't a missing code."""
    return F.when(~num(x).isin(*MISSING_NUMBERS), num(x))


def as_date(x, cut: bool = False) -> Column:
    """yyyy-M-d as a date; `cut` drops what follows the first blank.  The pattern keeps out what a cast would take besides."""
    x = F.substring_index(c(x), " ", 1) if cut else c(x)
    return F.when(x.rlike(_DATE), x.try_cast("date"))


def as_minute(x) -> Column:
    """yyyy-MM-dd HH:mm as a timestamp."""
    return F.when(c(x).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$"), F.try_to_timestamp(c(x), "yyyy-MM-dd HH:mm"))


def real_date(x, cut: bool = False) -> Column:
    """A date that isn't one of the missing ones."""
    return F.when(~(F.substring_index(c(x), " ", 1) if cut else c(x)).isin(*MISSING_DATES), as_date(x, cut))


def clean_date_text(x) -> Column:
    """Slashes become dashes; what follows a blank or a T goes."""
    return F.split_part(F.split_part(F.replace(c(x), "/", "-"), " ", 1), "T", 1)


def days_between(a: Column, b: Column) -> Column:
    return F.absolute(F.datediff(b, a))


def days_since(x, run_date: Column) -> Column:
    return F.datediff(run_date, as_date(clean_date_text(x)))


def years_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a) / 365.0


def first_digits(x) -> Column:
    return F.regexp_extract(c(x), r"(\d+)", 1)


def timepoint_alias(x) -> Column:
    return F.regexp_replace(F.regexp_replace(c(x), "^screen$", "screening"), "^baseln$", "baseline")


def strip_tags(x) -> Column:
    return F.translate(F.regexp_replace(c(x), "<.*?>", ""), "<>/\n", "")


def network_completion(name: str) -> str:
    """The completion column of the network that keeps its own."""
    return name.replace("_hc", "").replace("onboarding", "checkin") + "_rpms"


def value_class(x) -> Column:
    """missing, number, date, blank, text; the first that fits."""
    return (
        F.when(is_missing(x), "missing").when(is_number(x), "number").when(as_date(x, cut=True).isNotNull(), "date").when(is_blank(x), "blank").when(c(x).isNotNull(), "text").otherwise("other")
    )


def freshness(days: Column, resolved: Column, manual: Column) -> Column:
    """The class of a tracker row: manual before resolved before age; grey without an age."""
    age = F.when(days < 7, "yellow").when(days < 14, "orange").when(days >= 14, "red").otherwise("grey")
    return F.when(manual, "blue").when(resolved, "green").otherwise(age)


class _OfText:
    """The functions above with names as SQL text."""

    def __getattr__(self, name):
        made = globals()[name]
        return lambda x, *more, **named: made(F.col(x) if isinstance(x, str) else x, *more, **named)


of_text = _OfText()

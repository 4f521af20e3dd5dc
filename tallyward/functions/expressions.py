"""Expressions as Spark SQL text, for rules and gates that a dictionary makes by the thousand.

A `Sql` behaves like a column (operators, isin, cast, when ...), but it is text, made on the driver without a call to the JVM; a whole set of rules then
becomes one parsed expression.  The functions here take columns too: without a `Sql` among the arguments they give a column, so that one definition
(`functions.values`) serves both.  Arguments that are neither are literals.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


class Sql:
    """A piece of Spark SQL."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text

    def __repr__(self) -> str:
        return f"Sql({self.text})"

    def _with(self, sign: str, other, turned: bool = False) -> Sql:
        a, b = (text_of(other), self.text) if turned else (self.text, text_of(other))
        return Sql(f"({a} {sign} {b})")

    def __eq__(self, other):
        return self._with("=", other)

    def __ne__(self, other):
        return self._with("!=", other)

    __hash__ = None

    def __lt__(self, other):
        return self._with("<", other)

    def __le__(self, other):
        return self._with("<=", other)

    def __gt__(self, other):
        return self._with(">", other)

    def __ge__(self, other):
        return self._with(">=", other)

    def __and__(self, other):
        return self._with("AND", other)

    def __or__(self, other):
        return self._with("OR", other)

    def __add__(self, other):
        return self._with("+", other)

    def __sub__(self, other):
        return self._with("-", other)

    def __mul__(self, other):
        return self._with("*", other)

    def __truediv__(self, other):
        return self._with("/", other)

    def __rsub__(self, other):
        return self._with("-", other, turned=True)

    def __rmul__(self, other):
        return self._with("*", other, turned=True)

    def __invert__(self):
        return Sql(f"(NOT {self.text})")

    def isNull(self):
        return Sql(f"({self.text} IS NULL)")

    def isNotNull(self):
        return Sql(f"({self.text} IS NOT NULL)")

    def isin(self, *values):
        return Sql(f"({self.text} IN ({', '.join(map(text_of, values))}))") if values else Sql("false")

    def rlike(self, pattern: str):
        return Sql(f"({self.text} RLIKE {text_of(pattern)})")

    def contains(self, part: str):
        return Sql(f"contains({self.text}, {text_of(part)})")

    def cast(self, kind: str):
        return Sql(f"CAST({self.text} AS {kind})")

    def try_cast(self, kind: str):
        return Sql(f"TRY_CAST({self.text} AS {kind})")


class Case(Sql):
    """CASE WHEN ... END that can take more branches."""

    __slots__ = ("branches",)

    def __init__(self, branches: tuple[str, ...], last: str = ""):
        super().__init__(f"(CASE {' '.join(branches)}{last} END)")
        self.branches = branches

    def when(self, test, value) -> Case:
        return Case((*self.branches, f"WHEN {text_of(test)} THEN {text_of(value)}"))

    def otherwise(self, value) -> Sql:
        return Case(self.branches, f" ELSE {text_of(value)}")


def text_of(x) -> str:
    """The text of an expression or a literal."""
    if isinstance(x, Sql):
        return x.text
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, float):
        return f"{x!r}D"
    if isinstance(x, int):
        return str(x)
    if isinstance(x, str):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"
    if isinstance(x, datetime.date):
        return f"DATE'{x.isoformat()}'"
    raise TypeError(f"no SQL text for {x!r}")


def col(name: str) -> Sql:
    return Sql(f"`{name.replace('`', '``')}`")


def lit(x) -> Sql:
    return x if isinstance(x, Sql) else Sql(text_of(x))


def expr(text: str) -> Sql:
    return Sql(f"({text})")


def names(values) -> Sql:
    """An array of texts."""
    return Sql(f"CAST(array({', '.join(map(text_of, values))}) AS array<string>)")


def when(test, value):
    if isinstance(test, Sql):
        return Case((f"WHEN {test.text} THEN {text_of(value)}",))
    return F.when(test, value)


def _function(name: str) -> Callable:
    def call(*arguments):
        if any(isinstance(a, Column) for a in arguments):
            return F.call_function(name, *[a if isinstance(a, Column) else F.lit(a) for a in arguments])
        return Sql(f"{name}({', '.join(map(text_of, arguments))})")

    return call


coalesce, concat, trim, lower, length, substring_index, split_part, replace, translate = map(_function, ("coalesce", "concat", "trim", "lower", "length", "substring_index", "split_part", "replace", "translate"))
regexp_extract, regexp_replace, try_to_timestamp, datediff, absolute, rounded = map(_function, ("regexp_extract", "regexp_replace", "try_to_timestamp", "datediff", "abs", "round"))
least, greatest, array, array_max, array_join, array_distinct, array_contains, size = map(_function, ("least", "greatest", "array", "array_max", "array_join", "array_distinct", "array_contains", "size"))


def present(cells: Sql) -> Sql:
    """An array without its nulls."""
    return Sql(f"filter({cells.text}, x -> x IS NOT NULL)")

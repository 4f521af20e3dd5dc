"""The rule engine: rules are data, written as SQL text, and evaluation is one parsed expression for fifty of them.

A rule names forms and variables, says when it fires and with what message.  It fires only in rows whose file has all its variables, whose
cohort and forms are due (the gate), and in which its variables apply.  What a set of rules says is put together as text on the driver, without a call to the JVM for each piece; what
doesn't depend on the row (names, forms, reports) stays in a table of a row for each rule.  Cells that rules take as numbers are read as numbers once, in a projection below.
Single-variable rules over many variables take the long path: the cells in question become rows that are joined to a small rule table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.expressions import Sql, col
from tallyward.functions.values import of_text as cell

#: Rules in one projection; beyond it, more projections are cheaper than wider ones.
CHUNK = 50
FOUND = "array<struct<seq:int,error_message:string,named:array<string>>>"
LISTED = "seq int, rule string, forms array<string>, variables array<string>, reports array<string>, withdrawn_enabled boolean, excluded_enabled boolean"
#: Networks whose rows a set of excluded variables holds for; a plain set holds for all.
Excluded = frozenset[str] | Mapping[str, frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """One check.  fires and message are SQL text (`functions.expressions`); `variables` must be in the row's file for the rule to fire.

    `named` is an array of the variables that a flag names, where they depend on the row; E2: `withdrawn` and `excluded` keep the reports
    of flags of removed and of not included subjects.
    """

    name: str
    variables: tuple[str, ...]
    fires: Sql
    message: Sql
    forms: tuple[str, ...] = ()
    reports: tuple[str, ...] = ("Main Report",)
    gated: bool = True
    exclusions: bool = True
    applies: tuple[str, ...] = ()
    only: Sql | None = None
    named: Sql | None = None
    withdrawn: bool = False
    excluded: bool = False


def all_of(tests: Iterable[Sql]) -> Sql:
    tests = list(tests)
    return sql.expr(" AND ".join(t.text for t in tests)) if tests else sql.lit(True)


def any_of(tests: Iterable[Sql]) -> Sql:
    tests = list(tests)
    return sql.expr(" OR ".join(t.text for t in tests)) if tests else sql.lit(False)


def text(*parts) -> Sql:
    """A message of literals and columns."""
    return sql.concat(*[p if isinstance(p, str) else p.cast("string") for p in parts])


def usable(rules: Iterable[Rule], columns: Iterable[str], excluded: frozenset[str] = frozenset()) -> list[Rule]:
    """Rules whose variables some file has and that touch no excluded variable (unless they say that doesn't matter)."""
    known = set(columns)
    return [r for r in rules if known.issuperset(r.variables) and not (r.exclusions and excluded.intersection(r.variables))]


def elsewhere(variables: Iterable[str], excluded: Excluded) -> list[Sql]:
    """The tests that keep variables out of the networks in which they are excluded (none of a plain set)."""
    if not isinstance(excluded, Mapping):
        return []
    barred = sorted(n for n, names in excluded.items() if names.intersection(variables))
    return [~sql.coalesce(col("network").isin(*barred), False)] if barred else []


_NUMBERED = re.compile(re.escape(v.num(col("@")).text).replace("@", r"([^`]+)", 1).replace("@", r"\1"))


def numbered(texts: list[str]) -> tuple[list[str], list[str]]:
    """The texts with cells' numbers as columns, and the projection that makes these."""
    found: dict[str, str] = {}

    def taken(m: re.Match) -> str:
        found[m[1]] = m[0]
        return f"`_n_{m[1]}`"

    out = [_NUMBERED.sub(taken, t) for t in texts]
    return out, [f"{made} AS `_n_{x}`" for x, made in found.items()]


def compiled(ready: list[Rule], gate, applies, excluded: Excluded) -> list[tuple[str, list[str]]]:
    """The expressions of a set of rules, for each chunk an array of what fired and, for the projection below it, each rule's test (_f_ and its number).

    The array goes through a lambda, so all in it is interpreted; tests are columns of their own, as they are compiled there.
    """
    tests = [f"{_fires(r, gate, applies, excluded).text} AS `_f_{i}`" for i, r in enumerate(ready)]
    found = [f"CASE WHEN `_f_{i}` THEN {_found(i, r)} END" for i, r in enumerate(ready)]
    return [(f"CAST(filter(array({', '.join(found[at : at + CHUNK])}), x -> x IS NOT NULL) AS {FOUND})", tests[at : at + CHUNK]) for at in range(0, len(found), CHUNK)]


def evaluate(rows: DataFrame, rules: Iterable[Rule], keep: list[str], gate: Callable[[str], Sql] | None = None, applies: Callable[[str], Sql] | None = None, excluded: Excluded = frozenset()) -> DataFrame:
    """A row for each violation: the kept columns and seq, rule, forms, variables, error_message, reports, withdrawn_enabled, excluded_enabled.

    excluded: variables that no rule may touch, in all rows or by network (then the rows need a network).
    """
    ready = usable(rules, rows.columns, excluded if isinstance(excluded, frozenset) else frozenset())
    chunks = []
    for made, tests in compiled(ready, gate, applies, excluded):
        (made, *tests), numbers = numbered([made, *tests])
        chunks.append(rows.selectExpr("*", *numbers).selectExpr("*", *tests).select(*keep, F.expr(f"inline({made})")))
    if not chunks:
        chunks = [rows.where("false").select(*keep, F.expr(f"inline(CAST(array() AS {FOUND}))"))]
    listed = [(i, r.name, list(r.forms), list(r.variables), list(r.reports), r.withdrawn, r.excluded) for i, r in enumerate(ready)]
    table = rows.sparkSession.createDataFrame(listed, LISTED).coalesce(1)  # a row for each rule
    found = reduce(DataFrame.unionByName, chunks).join(F.broadcast(table), "seq")
    return found.withColumn("variables", F.coalesce("named", "variables")).select(*keep, "seq", "rule", "forms", "variables", "error_message", "reports", "withdrawn_enabled", "excluded_enabled")


def _fires(rule: Rule, gate, applies, excluded: Excluded) -> Sql:
    tests = [col(x).isNotNull() for x in rule.variables]
    if rule.only is not None:
        tests.append(rule.only)
    if rule.exclusions:
        tests += elsewhere(rule.variables, excluded)
    if rule.gated and gate is not None:
        tests += [gate(f) for f in rule.forms]
    tests.append(rule.fires)
    if applies is not None:
        tests += [applies(x) for x in rule.applies]
    return sql.coalesce(all_of(tests), False)


def _found(seq: int, rule: Rule) -> str:
    first = sql.concat(sql.expr(f"get({rule.named.text}, 0)"), " : ") if rule.named is not None else sql.lit(rule.variables[0] + " : " if rule.variables else "")
    return f"named_struct('seq', {seq}, 'error_message', {text(first, rule.message).text}, 'named', {'CAST(NULL AS array<string>)' if rule.named is None else rule.named.text})"


# templates


def in_set(name: str, variable: str, codes, negate: bool = False, **more) -> Rule:
    """The value is one of the codes (or, negated, is filled and none of them)."""
    hit = cell.code_in(variable, codes)
    return Rule(name, (variable,), cell.filled(variable) & ~hit if negate else hit, text(f"{variable} is ", col(variable)), **more)


def outside(name: str, variable: str, low: float | None, high: float | None, **more) -> Rule:
    """The value lies outside [low, high]; missing codes and text are neither."""
    x = cell.value(variable)
    tests = ([x < low] if low is not None else []) + ([x > high] if high is not None else [])
    return Rule(name, (variable,), any_of(tests), text(f"{variable} is out of range (value = ", col(variable), ")"), **more)


def ordered(name: str, first: str, second: str, parse=cell.as_date, **more) -> Rule:
    """The first date is later than the second."""
    ok = ~cell.is_empty(first) & ~cell.is_empty(second)
    return Rule(name, (first, second), ok & (parse(first) > parse(second)), text(f"{first} (", col(first), f") is later than {second} (", col(second), ")"), **more)


def implies(name: str, variables: tuple[str, ...], when: Sql, then: Sql, message: Sql | str, **more) -> Rule:
    """T4: `when` holds although `then` doesn't."""
    return Rule(name, variables, when & ~then, sql.lit(message) if isinstance(message, str) else message, **more)


def gap(name: str, first: str, second: str, days: int, **more) -> Rule:
    """T5: more than so many days lie between two dates."""
    between = v.days_between(cell.real_date(first, True), cell.real_date(second, True))
    return Rule(name, (first, second), between > days, text("There are ", between, f" days between {first} and {second}"), **more)


def pattern(name: str, variable: str, wanted: str, message: str, **more) -> Rule:
    """A non-blank text doesn't match."""
    return Rule(name, (variable,), ~cell.is_blank(variable) & ~col(variable).rlike(wanted), text(f"{message} (", col(variable), ")"), **more)


def tolerance(name: str, total: str, part: str, share: float, read=cell.value, **more) -> Rule:
    """A sum isn't within a share of a total; read: how a number is read (`cell.num` where no code stands for a missing one, as in sums)."""
    a, b = read(part), read(total)
    return Rule(name, (total, part), (a < b - share * b) | (a > b + share * b), text(f"{part} (", col(part), f") is not within {share:.0%} of {total} (", col(total), ")"), **more)


# the long path


def long_form(rows: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """(keys, variable, value) of the variables that a row's file has."""
    return rows.select(*keys, *[F.col(x).cast("string").alias(x) for x in variables]).unpivot(keys, variables, "variable", "value").where("value is not null")


def eligible_cells(
    rows: DataFrame, keys: list[str], forms: dict[str, str], gate: Callable[[str], Sql] | None = None, applies: Callable[[str], Sql] | None = None,
    excluded: Excluded = frozenset(), skipped: Callable[[str], Sql] | None = None,
) -> DataFrame:
    """The long form of the cells that single-variable checks may judge; forms: variable -> its form.

    As `evaluate` does for rules: the form passes the gate (F1, F2), no excluded variable takes part (P20), the variable applies in the row
    (P24) and isn't one of a skipped module (F7).  Other cells never leave the projection.
    """

    def judged(x: str) -> Sql:
        return all_of(([applies(x)] if applies else []) + ([~skipped(x)] if skipped else []))

    found = marked_cells(rows, keys, forms, judged, gate, excluded, lambda x: x.judged)
    return found.select(*keys, "variable", "value")


@dataclass(frozen=True)
class Marked:
    """What a cell's mark may depend on: its text and whether it is judged."""

    value: Sql
    judged: Sql


def marked_cells(rows: DataFrame, keys: list[str], forms: dict[str, str], judged: Callable[[str], Sql], gate=None, excluded: Excluded = frozenset(), wanted: Callable[[Marked], Sql] | None = None, checked: frozenset[str] = frozenset()) -> DataFrame:
    """(keys, variable, form, value, judged) of the cells whose form passes the gate and that aren't excluded; wanted: which of them, and all cells of `checked` variables.

    One expression: an array of the cells that the tests take; which are judged and taken are two arrays below it, as they are compiled there and what a
    lambda filters is interpreted.
    """
    judging, taking, made = [], [], []
    known, barred = set(rows.columns), excluded if isinstance(excluded, frozenset) else frozenset()
    texts = {name for name, kind in rows.dtypes if kind == "string"}
    for x, form in forms.items():
        if x in known and x not in barred:
            cell_is = Marked(col(x) if x in texts else col(x).cast("string"), sql.coalesce(judged(x), False))
            tests = [cell_is.value.isNotNull(), *([gate(form)] if gate else []), *elsewhere((x,), excluded), *([wanted(cell_is)] if wanted and x not in checked else [])]
            at = len(made)
            judging.append(cell_is.judged.text)
            taking.append(all_of(tests).text)
            made.append(f"CASE WHEN get(_taken, {at}) THEN named_struct('variable', {sql.text_of(x)}, 'form', {sql.text_of(form)}, 'value', {cell_is.value.text}, 'judged', get(_judged, {at})) END")
    if not made:
        return rows.where("false").select(*keys, F.lit("").alias("variable"), F.lit("").alias("form"), F.lit("").alias("value"), F.lit(False).alias("judged"))
    tests, numbers = numbered([f"array({', '.join(judging)}) AS _judged", f"array({', '.join(taking)}) AS _taken"])
    return rows.selectExpr("*", *numbers).selectExpr("*", *tests).select(*keys, F.expr(f"inline(filter(array({', '.join(made)}), x -> x IS NOT NULL))"))


def blank_checks(long: DataFrame, table: DataFrame) -> DataFrame:
    """Listed variables that are blank; table: (variable, form, report)."""
    return long.where(v.is_blank("value")).join(table, "variable").withColumn("error_message", F.lit("Variable is blank."))


def missing_code_checks(long: DataFrame, table: DataFrame, by: str | list[str] = "variable") -> DataFrame:
    """R2: listed variables (by network, if `by` says so) that hold a missing code or the text NaN."""
    hit = v.is_missing("value") | F.coalesce(F.col("value") == "NaN", F.lit(False))
    return long.where(hit).join(table, by).withColumn("error_message", F.concat(F.lit("Variable is a missing code (value = "), "value", F.lit(").")))


def specific_value_checks(long: DataFrame, table: DataFrame) -> DataFrame:
    """The value is in a rule's set (or, negated, is not); table: (variable, codes array<double>, negate, message)."""
    joined = long.join(table, "variable")
    hit = F.coalesce(F.array_contains("codes", v.num("value")), F.lit(False))
    return joined.where(hit != F.col("negate")).withColumn("error_message", F.concat("message", F.lit(" (value = "), "value", F.lit(")")))


def range_checks(long: DataFrame, table: DataFrame) -> DataFrame:
    """A number that isn't a missing code lies outside its variable's range; table: (variable, low, high)."""
    joined = long.join(table, "variable")
    x = v.value("value")
    return joined.where((x < F.col("low")) | (x > F.col("high"))).withColumn("error_message", F.concat("variable", F.lit(" is out of range (value = "), "value", F.lit(")")))


# rules over slots


def slots(rows: DataFrame, keys: list[str], count: int, fields: dict[str, str]) -> DataFrame:
    """A row for each filled slot of a repeated group; fields: name -> column pattern with {n}."""
    known = set(rows.columns)
    cells = lambda n: ", ".join(f"CAST({col(p.format(n=n)).text if p.format(n=n) in known else 'NULL'} AS string) AS {name}" for name, p in fields.items())
    made = [f"struct({n} AS slot, {cells(n)})" for n in range(1, count + 1)]
    filled = v.filled(Sql(f"x.{next(iter(fields))}"))
    if not made:
        return rows.where("false").selectExpr(*[f"`{k}`" for k in keys], "0 AS slot", *[f"'' AS {name}" for name in fields])
    return rows.select(*keys, F.expr(f"inline(filter(array({', '.join(made)}), x -> {filled.text}))"))


def repeated_in_slots(filled: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The same name in two different slots, one row for each pair; slots of a row meet by its keys."""
    a, b = filled.alias("a"), filled.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, name]]
    pairs = a.join(b, [*same, F.col("a.slot") < F.col("b.slot")])
    return pairs.select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{name}").alias(name), F.col("a.slot").alias("slot_1"), F.col("b.slot").alias("slot_2"))


#: Steps between the sizes of time cells, in powers of two, and the largest.
CELL_STEP, CELL_LARGEST = 3, 60


def overlapping(spans: DataFrame, keys: list[str], start: str, end: str, order: str) -> DataFrame:
    """Pairs of spans of one key that share a day or an instant; dates, timestamps or texts that read as such.

    A span lies in one or two cells of time of its own size (the next power of eight, in microseconds), and is looked for in the cells of all larger
    sizes: two spans meet in cells of the longer one's size, so what never comes near each other is never joined, whatever the lengths are.  Copies are bounded by the number of sizes,
    a key's spans are dealt to tasks by cell, and a pair is kept in the first cell that both touch, so none comes twice.
    """
    micros = lambda x: f"unix_micros(TRY_CAST(`{x}` AS timestamp))"
    ends = {"_low": F.expr(f"least({micros(start)}, {micros(end)})"), "_high": F.expr(f"greatest({micros(start)}, {micros(end)})")}
    held = spans.select(*keys, start, end, order).where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns(ends)
    held = held.withColumn("_size", F.expr(f"CAST(least(ceil(length(bin(_high - _low + 1)) / {CELL_STEP}) * {CELL_STEP}, {CELL_LARGEST}) AS int)"))
    cells = F.expr("explode(array_distinct(array(shiftright(_low, _cells), shiftright(_high, _cells)))) AS _cell")
    own = held.withColumn("_cells", F.col("_size")).select("*", cells).alias("b")
    every = held.withColumn("_cells", F.explode(F.sequence(F.col("_size"), F.lit(CELL_LARGEST), F.lit(CELL_STEP)))).select("*", cells).alias("a")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    meets = (F.col(f"a.{start}") <= F.col(f"b.{end}")) & (F.col(f"b.{start}") <= F.col(f"a.{end}"))
    once = F.expr("a._cell = greatest(shiftright(a._low, a._cells), shiftright(b._low, a._cells))")
    other = F.when(F.col("a._size") == F.col("b._size"), F.col(f"a.{order}") < F.col(f"b.{order}")).otherwise(F.col(f"a.{order}") != F.col(f"b.{order}"))
    pairs = every.join(own, [*same, F.col("a._cells") == F.col("b._cells"), F.col("a._cell") == F.col("b._cell"), once, other, meets])
    return pairs.select(*[F.col(f"a.{k}").alias(k) for k in keys], F.least(f"a.{order}", f"b.{order}").alias(f"{order}_1"), F.greatest(f"a.{order}", f"b.{order}").alias(f"{order}_2"))

"""Discovery jobs: what variables hold, which values stand out, which variables agree, which raters differ."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import expressions as sql
from tallyward.functions import values as v
from tallyward.functions.values import of_text as cell
from tallyward.sources.stages import written

CLASSES = ("missing", "number", "date", "blank", "text", "other")


def type_distribution(long: DataFrame) -> DataFrame:
    """A3: for each variable, how many values of each class."""
    counts = [F.count_if(F.col("class") == k).alias(f"n_{k}") for k in CLASSES]
    return long.withColumn("class", v.value_class("value")).groupBy("variable").agg(*counts)


def variables_of_type(distribution: DataFrame, kind: str, share: float) -> DataFrame:
    """A4: variables in which the class has more than a share of numbers, texts and dates."""
    part = F.try_divide(F.col(f"n_{kind}"), F.col("n_number") + F.col("n_text") + F.col("n_date"))
    return distribution.where(part > share).select("variable", part.alias("share"))


def earliest_use(rows: DataFrame, variable: str, date: str, since: Column) -> DataFrame:
    """A2, O3: the first date of each variable from `since` on, newest first."""
    return rows.where(F.col(date) >= since).groupBy(variable).agg(F.min(date).alias("earliest")).orderBy(F.desc("earliest"), variable)


#: Entries of a quantile sketch (its rank error is a group's rows divided by it), and parts that a group's rows are dealt to beside their brackets.
ACCURACY, SALTS = 10_000, 32


def middle_counts(rows: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """(keys, _name, _v, _n, _all): how often each value near the middle of a group occurs; a null _v stands for all that lies below.

    Splitters come from the data: a mergeable quantile sketch brackets the median of each group, a few ten-thousandths of its rows on either side, however
    crowded or spread its values are.  Rows meet their group's bracket by group and salt, so that no task holds a group, and equal values are counted before they are moved.
    """
    margin = 3 / ACCURACY
    wide = rows.select(*keys, *[x.cast("double").alias(f"_x{i}") for i, x in enumerate(columns.values())])
    made = [f for i in range(len(columns)) for f in (F.percentile_approx(f"_x{i}", [0.5 - margin, 0.5 + margin], ACCURACY).alias(f"_b{i}"), F.count(f"_x{i}").alias(f"_n{i}"))]
    brackets = wide.groupBy(*keys).agg(*made).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = wide.withColumn("_salt", F.pmod(F.xxhash64(*[f"_x{i}" for i in range(len(columns))]), F.lit(SALTS)).cast("int"))
    joined = _on([*keys, "_salt"], salted, brackets)
    cells = ", ".join(f"CASE WHEN _x{i} <= _b{i}[1] THEN named_struct('_name', {i}, '_v', CASE WHEN _x{i} >= _b{i}[0] THEN _x{i} END, '_all', _n{i}) END" for i in range(len(columns)))
    near = joined.select(*keys, F.expr(f"inline(filter(array({cells}), c -> c IS NOT NULL))"))
    return near.groupBy(*keys, "_name", "_v").agg(F.count("*").alias("_n"), F.first("_all").alias("_all"))


def exact_medians(rows: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """(keys, and the exact median of each named number), without a group's values in one place: only the distinct values of `middle_counts` are put in order."""
    counts = middle_counts(rows, keys, columns)
    before = F.sum("_n").over(Window.partitionBy(*keys, "_name").orderBy(F.asc_nulls_first("_v"))) - F.col("_n")
    ranked = counts.withColumn("_rank", before).where("_v IS NOT NULL")
    at = lambda r: F.max(F.expr(f"CASE WHEN _rank <= {r} AND {r} < _rank + _n THEN _v END"))
    found = ranked.groupBy(*keys, "_name").agg(((at("floor((_all - 1) / 2)") + at("floor(_all / 2)")) / 2).alias("_median"))
    return found.groupBy(*keys).agg(*[F.max(F.expr(f"CASE WHEN _name = {i} THEN _median END")).alias(name) for i, name in enumerate(columns)])


def _on(keys: list[str], left: DataFrame, right: DataFrame) -> DataFrame:
    """Left and right joined on keys of which nulls are equal."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[x for x in right.columns if x not in keys])
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])


def median_compare(long: DataFrame, side: str, sides: tuple[str, str], keys: list[str], value: str = "value") -> DataFrame:
    """A10: medians of two sides and their symmetric difference in percent; 0 if a side has no rows or the average is 0."""
    a, b = sides
    counts = long.groupBy(*keys).agg(*[F.count_if(F.col(side) == s).alias(f"rows_{i}") for i, s in enumerate((a, b))])
    medians = _on(keys, counts, exact_medians(long, keys, {f"median_{i}": F.when(F.col(side) == s, F.col(value)) for i, s in enumerate((a, b))}))
    mean = (F.col("median_0") + F.col("median_1")) / 2
    difference = F.when((F.col("rows_0") == 0) | (F.col("rows_1") == 0), 0.0).when(mean == 0, 0.0).otherwise(F.abs(F.col("median_0") - F.col("median_1")) / mean * 100)
    return medians.select(*keys, "median_0", "median_1", difference.alias("difference"))


def z_scores(long: DataFrame, keys: list[str], value: str = "value", least: int = 0) -> DataFrame:
    """Each value's distance from its group's mean in standard deviations, with the group's median; groups without spread are left out."""
    x = F.col(value)
    stats = long.where(x.isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    stats = _on(keys, stats.where((F.col("std") > 0) & (F.col("n") > least)), exact_medians(long, keys, {"median": x}))
    return long.where(x.isNotNull()).join(stats, keys).withColumn("z", F.abs(F.col("mean") - x) / F.col("std"))


def mostly_numeric(long: DataFrame, share: float = 0.9) -> DataFrame:
    """Variables of which more than a share of the answers are numbers; blanks and missing codes are no answers."""
    answered = long.where(~v.is_empty("value") & ~F.lower("value").isin("na", "n/a", "nan", "nil"))
    answered = answered.withColumn("value", F.split_part("value", F.lit(" "), F.lit(1)))
    return answered.groupBy("variable").agg(F.count("*").alias("n"), F.avg(v.is_number("value").cast("double")).alias("share")).where(F.col("share") > share)


def partly_numeric(long: DataFrame, share: float = 0.9) -> DataFrame:
    """What isn't a number in variables that hold both but aren't mostly numeric."""
    answered = long.where(~v.is_empty("value"))
    shares = answered.groupBy("variable").agg(F.avg(v.is_number("value").cast("double")).alias("share")).where((F.col("share") > 0) & (F.col("share") <= share))
    return answered.where(~v.is_number("value")).join(shares, "variable")


def deviations(long: DataFrame, keys: list[str], value: str = "value", times: float = 3, least: int = 10, mean: float = 3) -> DataFrame:
    """Values more than some standard deviations from the mean, in groups of enough values with a mean that is large enough."""
    scored = z_scores(long, keys, value)
    return scored.where((F.col("n") >= least) & (F.col("mean") >= mean) & (F.abs(F.col(value) - F.col("mean")) > times * F.col("std")))


def blocked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows dealt to blocks that follow one another within each key, written once; `_block` numbers them."""
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(blocks, key, *order).withColumn("_block", F.spark_partition_id()), "blocks")


def running_before(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The sum of a column over a key's earlier rows, on rows of `blocked` (by the first key and this order).

    Sums run within blocks; the blocks' own sums run over the blocks, a row for each key and block; a row's sum is both.  So no task holds all of a key's rows.
    """
    within = F.sum(value).over(Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sums = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    earlier = sums.withColumn("_offset", F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).drop("_sum").where("_offset IS NOT NULL")
    out = _on([*keys, "_block"], rows.withColumn(name, within), earlier)
    return out.withColumn(name, F.coalesce(name, F.lit(0)) + F.coalesce("_offset", F.lit(0))).drop("_offset")


def rater_scores(scored: DataFrame, rater: str, subject: str, form: str, variable: str, z: str, order: list[str], cut: float = 2.0) -> DataFrame:
    """Each rater's outlier score.

    In order, a value adds z ** 0.75, halved for each earlier outlier of the rater, subject and form, and multiplied by z ** 0.25 of each earlier first
    outlier of the rater and variable in a subject; the score is the mean.  Running sums over blocks, one for each factor.
    """
    use = scored.where(F.col(rater).isNotNull() & (F.col(rater) != "") & (F.col(rater) != "[survey respondent]"))
    columns = list(dict.fromkeys([rater, subject, form, variable, z, *order]))
    use = blocked(use.select(*columns, (F.col(z) > cut).cast("int").alias("_out")), rater, order)
    use = running_before(use, [rater, subject, variable], order, "_out", "_earlier")
    use = use.withColumn("_first", F.when((F.col("_out") == 1) & (F.col("_earlier") == 0), 0.25 * F.ln(F.col(z))).otherwise(0.0))
    use = running_before(use, [rater, subject, form], order, "_out", "_halved")
    use = running_before(use, [rater, variable], order, "_first", "_raised")
    part = F.pow(F.col(z), 0.75) * F.pow(F.lit(0.5), F.col("_halved")) * F.exp("_raised")
    return use.withColumn("_part", part).groupBy(rater).agg(F.avg("_part").alias("score"), F.count("*").alias("n"))


def _pair_rows(batches, count):
    """Sums of a task's pair counts, as (a, b, numbers): count gives a list of matrices for a matrix of rows."""
    held = None
    for batch in batches:
        if batch.num_rows:
            found = count(batch)
            held = found if held is None else [x + y for x, y in zip(held, found, strict=True)]
    if held is not None:
        a, b = np.nonzero(sum(held))
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *(pa.array(x[a, b]) for x in held)], names=["a", "b", *(f"n{i}" for i in range(len(held)))])


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of arrays of one width as a matrix, and where they aren't null."""
    flat = column.flatten()
    return np.asarray(flat.fill_null(0)).reshape(-1, width), np.asarray(flat.is_valid()).reshape(-1, width)


def _equal_counts(batch: pa.RecordBatch, numeric: np.ndarray, partners: list[np.ndarray]) -> list[np.ndarray]:
    """How often each column equals each of its partners (later columns)."""
    n = len(numeric)
    out = np.zeros((n, n), np.int64)
    (words, has), (numbers, is_number) = (_matrix(batch.column(x), n) for x in ("words", "numbers"))
    # a null equals nothing: each column's nulls get a value of their own
    words = np.where(has, words, np.arange(n, dtype=np.int64))
    numbers = np.where(is_number, numbers, np.arange(n, dtype=np.int64))
    for i, js in enumerate(partners):
        for one, use in ((words, js[~(numeric[js] & numeric[i])]), (numbers, js[numeric[js] & numeric[i]])):
            if len(use):
                out[i, use] = (one[:, i : i + 1] == one[:, use]).sum(axis=0)
    return [out]


def _kind_rows(batches, n: int):
    """For each column, how many cells are filled and how many aren't numbers."""
    filled, other = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for batch in batches:
        (words, has), (_, is_number) = (_matrix(batch.column(x), n) for x in ("words", "numbers"))
        blank, _ = _matrix(batch.column("blank"), n)
        filled += (has & (blank == 0)).sum(axis=0)
        other += (~is_number).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(filled), pa.array(other)], names=["column", "filled", "other"])


def _later_counts(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    days, has = _matrix(batch.column("days"), n)
    total, later = np.zeros((n, n), np.int64), np.zeros((n, n), np.int64)
    for i in range(n):
        both = has[:, i : i + 1] & has
        total[i] = both.sum(axis=0)
        later[i] = (both & (days[:, i : i + 1] > days)).sum(axis=0)
    return [total, later]


#: Columns up to which all pairs are compared by built-in expressions; rows of the sample that rules out pairs of more columns.
FEW_COLUMNS, SIGNATURE_ROWS = 12, 4096


def equal_pairs(rows: DataFrame, columns: list[str], share: float = 0.95, filled: int = 30, risk: float = 1e-12) -> DataFrame:
    """Pairs of columns that are equal in more than a share of the rows.

    Columns with few filled cells are left out; a pair is compared as numbers if both columns hold nothing else, otherwise as text (two blanks are equal).
    Few columns are compared by one aggregation.  For many, a signature of each column, its cells' hashes in about SIGNATURE_ROWS sampled rows, rules out the pairs
    whose share there lies further below `share` than chance allows (Hoeffding: a pair that does reach it is lost with a probability below `risk`); only the other pairs are counted over all
    rows, exactly but for 64-bit hashes of cells, by tasks that each sum one matrix.
    """
    return _few_equal_pairs(rows, columns, share, filled) if len(columns) <= FEW_COLUMNS else _many_equal_pairs(rows, columns, share, filled, risk)


def _few_equal_pairs(rows: DataFrame, columns: list[str], share: float, filled: int) -> DataFrame:
    number = {x: cell.num(sql.col(x)) for x in columns}
    texts = {x: sql.col(x).cast("string") for x in columns}
    tests = [f"named_struct('n', count_if({(sql.col(x).isNotNull() & ~cell.is_blank(x)).text}), 'numeric', count_if({number[x].isNull().text}) = 0) AS `{x}`" for x in columns]
    kinds = rows.selectExpr("count(*) AS _rows", *tests).first()
    names = [x for x in columns if kinds[x]["n"] > filled]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    one = lambda a, b: number if kinds[a]["numeric"] and kinds[b]["numeric"] else texts
    counts = [f"named_struct('variable_1', {sql.text_of(a)}, 'variable_2', {sql.text_of(b)}, 'n', count_if({(one(a, b)[a] == one(a, b)[b]).text}))" for a, b in pairs]
    if not counts:
        return rows.sparkSession.createDataFrame([], "variable_1 string, variable_2 string, share double")
    found = rows.select(F.expr(f"array({', '.join(counts)})").alias("pairs")).selectExpr("inline(pairs)")
    return found.select("variable_1", "variable_2", (F.col("n") / F.lit(kinds["_rows"])).alias("share")).where(F.col("share") > share)


def _many_equal_pairs(rows: DataFrame, columns: list[str], share: float, filled: int, risk: float) -> DataFrame:
    spark = rows.sparkSession

    def hashed(frame: DataFrame, names: list[str]) -> DataFrame:
        text = lambda x: sql.col(x).cast("string").text
        made = {
            "words": [f"CASE WHEN `{x}` IS NOT NULL THEN xxhash64({text(x)}) END" for x in names], "blank": [f"CAST({cell.is_blank(x).text} AS bigint)" for x in names],
            "numbers": [f"CASE WHEN {cell.num(x).isNotNull().text} THEN xxhash64({cell.num(x).text} + 0D) END" for x in names],
        }
        return frame.selectExpr(*[f"array({', '.join(cells)}) AS {name}" for name, cells in made.items()])

    n_rows = rows.count()
    found = hashed(rows, columns).mapInArrow(lambda batches: _kind_rows(batches, len(columns)), "column int, filled long, other long").groupBy("column").agg(F.sum("filled").alias("filled"), F.sum("other").alias("other"))
    kinds = {columns[r["column"]]: (r["filled"], r["other"] == 0) for r in found.collect()}  # a row for each column
    names = [x for x in columns if kinds.get(x, (0,))[0] > filled]
    if len(names) < 2:
        return spark.createDataFrame([], "variable_1 string, variable_2 string, share double")
    numeric = np.array([kinds[x][1] for x in names], bool)
    partners = [np.arange(i + 1, len(names)) for i in range(len(names))]

    def counted(cells: DataFrame, of: list[np.ndarray]) -> DataFrame:
        counts = cells.mapInArrow(lambda batches: _pair_rows(batches, lambda b: _equal_counts(b, numeric, of)), "a int, b int, n0 long")
        return counts.groupBy("a", "b").agg(F.sum("n0").alias("n"))

    if n_rows > 2 * SIGNATURE_ROWS:
        sample = written(hashed(rows.sample(SIGNATURE_ROWS / n_rows, seed=15), names), "signatures")
        taken = sample.count()
        least = share - math.sqrt(math.log(1 / risk) / (2 * max(1, taken)))
        alive = counted(sample, partners).where(F.col("n") >= F.lit(least * taken)).select("a", "b").toArrow()
        a, b = (np.asarray(alive.column(x)) for x in ("a", "b"))
        partners = [np.sort(b[a == i]).astype(np.int64) for i in range(len(names))]
    counts = counted(hashed(rows, names), partners)
    name = lambda x: F.element_at(F.lit(names), F.col(x) + 1)
    return counts.select(name("a").alias("variable_1"), name("b").alias("variable_2"), (F.col("n") / F.lit(n_rows)).alias("share")).where(F.col("share") > share)


def date_pairs(rows: DataFrame, columns: list[str]) -> DataFrame:
    """For every ordered pair of date variables, the rows that have both and the share in which the first is later; one scan, as `equal_pairs`."""
    spark, day = rows.sparkSession, {x: cell.as_date(sql.col(x).cast("string"), True) for x in columns}
    names = spark.createDataFrame(list(enumerate(columns)), "i int, name string").coalesce(1)
    pairs = names.select(F.col("i").alias("a"), F.col("name").alias("first")).join(F.broadcast(names.select(F.col("i").alias("b"), F.col("name").alias("second"))), F.col("a") != F.col("b"))  # a row for each pair of columns
    if len(columns) <= FEW_COLUMNS:
        days = rows.selectExpr(*[f"{d.text} AS d{i}" for i, d in enumerate(day.values())])
        made = [f"named_struct('a', {i}, 'b', {j}, 'total', count_if(d{i} IS NOT NULL AND d{j} IS NOT NULL), 'later', count_if(d{i} > d{j}))" for i in range(len(columns)) for j in range(len(columns)) if i != j]
        counts = days.select(F.expr(f"array({', '.join(made)})").alias("pairs")).selectExpr("inline(pairs)") if made else pairs.select("a", "b", F.lit(0).alias("total"), F.lit(0).alias("later"))
    else:
        days = rows.selectExpr(f"array({', '.join(f'unix_date({d.text})' for d in day.values())}) AS days")
        counts = days.mapInArrow(lambda batches: _pair_rows(batches, lambda x: _later_counts(x, len(columns))), "a int, b int, n0 long, n1 long")
        counts = counts.groupBy("a", "b").agg(F.sum("n0").alias("total"), F.sum("n1").alias("later"))
    found = pairs.join(counts, ["a", "b"], "left").select("first", "second", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("later", F.lit(0)).alias("later"))
    return found.withColumn("share", F.coalesce(F.try_divide("later", "total"), F.lit(0.0)))


def undeclared_dates(dictionary: DataFrame) -> DataFrame:
    """Variables that look like dates and aren't declared as such."""
    return dictionary.where(F.lower("variable").contains("date") & ~F.coalesce(F.col("validation").startswith("date"), F.lit(False))).select("variable")


#: Parts of the names of variables that the audit leaves out.
NOT_AUDITED = ("error", "chrsaliva_flag", "chrchs_flag", "_err", "invalid", "notes")


def auditable(long: DataFrame, mapped: DataFrame, excluded: DataFrame | None = None, identifiers: DataFrame | None = None) -> DataFrame:
    """the cells that `applicability_audit` is meant for; mapped, excluded and identifiers (left out for PRONET) hold variables.

    long also has network and its form's cells missing and complete (null: no such column).
    """
    named = F.lit(False)
    for part in NOT_AUDITED:
        named = named | F.col("variable").contains(part)
    rows = long.where(~v.is_code("missing", 1) & (F.col("complete").isNull() | v.is_code("complete", 2)) & ~named).join(mapped.select("variable"), "variable", "left_semi")
    if excluded is not None:
        rows = rows.join(excluded.select("variable"), "variable", "left_anti")
    if identifiers is not None:
        own = identifiers.select(F.col("variable").alias("_own"))
        rows = rows.join(own, (F.col("variable") == F.col("_own")) & (F.col("network") == "PRONET"), "left_anti")
    return rows


def applicability_audit(long: DataFrame, keys: list[str], subject: str, most: int = 50) -> DataFrame:
    """Values where a predicate is false, and blanks where it is true, counted with up to `most` subjects; long has value and applies
    (of `auditable` cells).

    Counts are summed over a finer split by subject first, and each part keeps its least subjects, so no group's subjects are gathered whole.
    """
    wrong = long.where(F.col("applies") == v.is_blank("value")).withColumn("side", F.when(F.col("applies"), "blank though applicable").otherwise("filled though not applicable"))
    group = [*keys, "variable", "value", "side"]
    per = wrong.groupBy(*group, subject).agg(F.count("*").alias("n"))
    parts = per.withColumn("_part", F.pmod(F.xxhash64(subject), F.lit(64)))
    some = lambda x: F.slice(F.array_sort(x), 1, most)
    rank = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(subject))
    least = parts.withColumn("_rank", rank)
    merged = least.groupBy(*group).agg(F.sum("n").alias("count"), some(F.collect_list(F.when(F.col("_rank") <= most, F.col(subject)))).alias("subjects"))
    return merged


# pairwise deviation: distances of points, by tiles

#: Points of a tile, and distances that are held at once.
TILE, NEAREST, BLOCK = 2048, 5, 1 << 17


def _nearer(best: np.ndarray, row: np.ndarray, d: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The NEAREST least distances of each row, sorted, of those known and of distances found, each as often as its point weighs."""
    times = np.minimum(weight, NEAREST)
    rows = np.concatenate([np.repeat(np.arange(len(best)), NEAREST), np.repeat(row, times)])
    all_d = np.concatenate([best.reshape(-1), np.repeat(d, times)])
    order = np.lexsort((all_d, rows))
    return all_d[order][np.searchsorted(rows[order], np.arange(len(best)))[:, None] + np.arange(NEAREST)]


def _places(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells; rows have whole groups of eight cells, which are looked at as one number first."""
    some = np.flatnonzero(hit.view(np.uint64))
    which, cell = np.nonzero(hit.reshape(-1, 8)[some])
    return np.divmod(some[which] * 8 + cell, hit.shape[1])


class _Sums:
    """What the points of a tile know of the points that have come by so far: the sum of distances and the nearest."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x, y
        self.total, self.near = np.zeros(len(x)), np.full((len(x), NEAREST), np.inf)

    def add(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        weights, step = weight.astype(np.float64), max(1, BLOCK // len(x))
        held = np.empty((2, min(step, len(self.x)), len(x)))  # made once: fresh pages for each block would cost more than its distances
        hit = np.zeros((held.shape[1], -(-len(x) // 8) * 8), bool)
        for at in range(0, len(self.x), step):
            own = slice(at, at + step)
            d, across = held[:, : len(self.x[own])]
            np.subtract(self.x[own, None], x, out=d)
            np.subtract(self.y[own, None], y, out=across)
            np.multiply(d, d, out=d)
            np.multiply(across, across, out=across)
            np.sqrt(np.add(d, across, out=d), out=d)
            self.total[own] += d @ weights
            bound = self.near[own, -1]
            if np.isinf(bound).any() and len(x) > NEAREST:  # nothing beyond the fifth point here can be among the nearest five
                bound = np.minimum(bound, np.nextafter(np.partition(d, NEAREST - 1, axis=1)[:, NEAREST - 1], np.inf))
            np.less(d, bound[:, None], out=hit[: len(d), : len(x)])
            row, other = _places(hit[: len(d)])
            if len(row):
                self.near[own] = _nearer(self.near[own], row, d[row, other], weight[other])


def _distance_rows(batches):
    """For each tile, which comes before the tiles that it is to meet: a row for each of its points."""
    grp = sums = None

    def found():
        near = [[x for x in row if x < np.inf] for row in sums.near.tolist()]
        return pa.RecordBatch.from_arrays([pa.array([grp] * len(sums.x)), pa.array(sums.x), pa.array(sums.y), pa.array(sums.total), pa.array(near, pa.list_(pa.float64()))], names=["grp", "x", "y", "total", "near"])

    for batch in batches:
        for i in range(batch.num_rows):
            x, y, weight = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("x", "y", "weight"))
            if batch.column("own")[i].as_py():
                if sums is not None:
                    yield found()
                grp, sums = batch.column("grp")[i].as_py(), _Sums(x, y)
            sums.add(x, y, weight)
    if sums is not None:
        yield found()


def pair_deviation(points: DataFrame, least: int = 50, trim: float = 2.5) -> DataFrame:
    """For each point (grp, id, x, y) the sum of its distances to all points of its group and to the nearest five (itself included), as
    deviations from the group's median in standard deviations.

    Points beyond `trim` standard deviations of the median in x or y are left out first; groups of fewer than `least` points too.  Equal points of a group
    become one with a weight, so that work is counted in distinct points.  These are dealt to tiles; a task gets a tile, then every tile of the group one after
    another, and gives each point of the first one row, so that neither pairs of points nor pairs of tiles are rows and a task holds two tiles.
    """
    w = ["grp"]
    stats = points.groupBy(*w).agg(*[F.stddev_samp(x).alias(f"std_{x}") for x in ("x", "y")])
    stats = _on(w, stats, exact_medians(points, w, {f"median_{x}": F.col(x) for x in ("x", "y")}))
    inside = [F.abs(F.col(x) - F.col(f"median_{x}")) <= trim * F.col(f"std_{x}") for x in ("x", "y")]
    held = points.join(stats, w).where(inside[0] & inside[1]).select("grp", "id", "x", "y")
    distinct = held.groupBy("grp", "x", "y").agg(F.count("*").alias("weight"))
    sizes = distinct.groupBy("grp").agg(F.sum("weight").alias("n"), F.count("*").alias("points")).where(F.col("n") >= least)
    tiles = distinct.join(sizes, "grp").withColumn("tiles", F.ceil(F.col("points") / TILE).cast("int")).withColumn("_of", F.pmod(F.xxhash64("x", "y"), F.col("tiles")).cast("int"))
    tiles = tiles.groupBy("grp", "tiles", "_of").agg(F.collect_list(F.struct("x", "y", "weight")).alias("p")).select("grp", "tiles", "_of", *[F.col(f"p.{c}").alias(c) for c in ("x", "y", "weight")])
    # a tile first meets itself; a number of partitions is given, as small tables of long work would be put together
    met = tiles.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("own", F.col("tile") == F.col("_of"))
    met = met.repartition(4 * points.sparkSession.sparkContext.defaultParallelism, "grp", "tile").sortWithinPartitions("grp", "tile", F.desc("own")).select("grp", "own", "x", "y", "weight")
    parts = met.mapInArrow(_distance_rows, "grp string, x double, y double, total double, near array<double>")
    near = F.aggregate("near", F.lit(0.0), lambda a, x: a + x)
    sums = held.join(parts.select("grp", "x", "y", F.col("total").alias("global"), near.alias("local")), ["grp", "x", "y"]).select("grp", "id", "global", "local")
    sums = written(sums, "distances")  # medians read them several times
    spread = sums.groupBy("grp").agg(*[F.stddev_samp(x).alias(f"std_{x}") for x in ("global", "local")])
    spread = _on(w, spread, exact_medians(sums, w, {f"median_{x}": F.col(x) for x in ("global", "local")}))
    deviation = lambda x: F.try_divide(F.abs(F.col(x) - F.col(f"median_{x}")), F.col(f"std_{x}"))
    return sums.join(spread, "grp").select("grp", "id", "global", "local", deviation("global").alias("global_deviation"), deviation("local").alias("local_deviation"))


def final_scores(pairs: DataFrame, outliers: DataFrame, keys: list[str], least: int = 5, above: float | None = 1.0) -> DataFrame:
    """Pair scores of a value summed up (totals, the five least), where there are enough, and their ratio to the value's own deviation.

    Pairs with neither score above `above` are left out first (None: all stay); if pairs has a column pair, `pairs` lists those that contribute.
    """
    if above is not None:
        pairs = pairs.where((F.col("global_deviation") > above) | (F.col("local_deviation") > above))
    listed = [F.array_sort(F.collect_list("pair")).alias("pairs")] if "pair" in pairs.columns else []
    five = lambda x: F.aggregate(F.slice(F.array_sort(F.collect_list(x)), 1, 5), F.lit(0.0), lambda a, y: a + y)
    summed = pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("global_deviation").alias("global_total"), F.sum("local_deviation").alias("local_total"), five("global_deviation").alias("global_least"), five("local_deviation").alias("local_least"), *listed)
    return summed.where(F.col("n") > least).join(outliers, keys).withColumn("ratio", F.try_divide("global_total", "z"))

"""Queries of operators beside a run: merged generations, raters of cells, reports, the audit, dates, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import diffs, discovery, flags, raters, rules, subjects, tracker
from tallyward.plans import model, run
from tallyward.plans.queries import CELLS, part_cells, query, t

RACKS = {"first": ("c_custkey % 40", "c_custkey % 9", "c_custkey % 7"), "second": ("c_custkey % 35", "c_custkey % 8", None)}


def generation(spark, sf_dir, which: str):
    """Customers as blood forms: a rack (999 and blanks among them) and positions."""
    rack, one, two = RACKS[which]
    cell = lambda x: F.expr(f"CASE WHEN {x} = 1 THEN '999' WHEN {x} = 2 THEN '' ELSE CAST({x} AS string) END")
    rows = t(spark, sf_dir, "customer").where("c_custkey % 4 != 0" if which == "first" else "c_custkey % 3 != 0")
    made = {"chrblood_rack": cell(rack), "chrblood_pos1": cell(one), "note": F.lit("x")} | ({"chrblood_pos2": cell(two)} if two else {})
    return rows.select(F.col("c_custkey").cast("string").alias("subjectid"), *[c.alias(x) for x, c in made.items()])


def _cell_sql(x: str) -> str:
    return f"CASE WHEN {x} = 1 THEN NULL WHEN {x} = 2 THEN NULL ELSE CAST({x} AS VARCHAR) END"


@query(f"""WITH v AS (SELECT c_custkey, {_cell_sql("c_custkey % 40")} || '_' || {_cell_sql("c_custkey % 9")} AS value FROM customer WHERE c_custkey % 4 <> 0
 UNION ALL SELECT c_custkey, {_cell_sql("c_custkey % 35")} || '_' || {_cell_sql("c_custkey % 8")} FROM customer WHERE c_custkey % 3 <> 0),
 p AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS subject, value FROM v WHERE value IS NOT NULL), s AS (SELECT value, count(*) AS subjects FROM p GROUP BY 1 HAVING count(*) > 1) SELECT value, subject, subjects FROM p JOIN s USING (value)""")
def q_shared_positions(spark, sf_dir):
    """The second generation has no second position, so that column keeps its name and takes no part."""
    merged = model.merged_generations(generation(spark, sf_dir, "first"), generation(spark, sf_dir, "second"), "chrblood")
    return subjects.shared_positions(merged, "chrblood_rack", ["chrblood_pos1", "chrblood_pos2"])


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS subjectid, CASE WHEN c_custkey % 4 <> 0 THEN coalesce({_cell_sql("c_custkey % 7")}, CASE WHEN c_custkey % 7 = 1 THEN '999' ELSE '' END) END AS pos2, c_custkey % 4 <> 0 AS first, c_custkey % 3 <> 0 AS second
 FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 3 <> 0""")
def q_merged_generations(spark, sf_dir):
    merged = model.merged_generations(generation(spark, sf_dir, "first"), generation(spark, sf_dir, "second"), "chrblood")
    return merged.select("subjectid", F.col("chrblood_pos2").alias("pos2"), F.col("chrblood_rack_baseln").isNotNull().alias("first"), F.col("chrblood_rack_month2").isNotNull().alias("second"))


@query("""WITH r AS (SELECT *, CASE WHEN o_custkey % 3 = 0 THEN 'PRESCIENT' ELSE 'PRONET' END AS network FROM orders),
 c AS (SELECT o_orderkey, o_custkey, network, 'one' AS variable, 'f' AS form, CAST(o_custkey % 50 AS DOUBLE) AS value, strftime(o_orderdate, '%Y-%m-%d') AS form_date, o_orderpriority AS own FROM r WHERE o_custkey % 50 <> 7
 UNION ALL SELECT o_orderkey, o_custkey, network, 'two', 'g', CAST(o_totalprice AS DOUBLE), '', '' FROM r)
 SELECT o_orderkey, variable, form, value, form_date, CASE WHEN network = 'PRESCIENT' AND o_custkey % 2 = 0 THEN 'rater ' || CAST(o_custkey % 5 AS VARCHAR) ELSE own END AS rater FROM c""")
def q_rater_values(spark, sf_dir):
    """Form f has a user and a date, form g none; the map knows every second subject, two raters of each."""
    orders = t(spark, sf_dir, "orders")
    one = F.when(F.col("o_custkey") % 50 == 7, "x").otherwise((F.col("o_custkey") % 50).cast("string"))
    rows = orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("subjectid"), F.when(F.col("o_custkey") % 3 == 0, "PRESCIENT").otherwise("PRONET").alias("network"), one.alias("one"), F.col("o_totalprice").cast("string").alias("two"),
        F.date_format("o_orderdate", "yyyy/MM/dd'T'HH:mm").alias("f_date"), F.col("o_orderpriority").alias("f_user"),
    )
    known = t(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("subject"), F.concat(F.lit("rater "), (F.col("c_custkey") % 5).cast("string")).alias("rater"))
    assigned = known.unionByName(known.withColumn("rater", F.lit("z")))
    found = raters.measured(rows, ["o_orderkey"], {"one": "f", "two": "g", "absent": "f"}, {"f": "f_user", "g": "g_user"}, {"f": "f_date"}, assigned)
    return found.select("o_orderkey", "variable", "form", "value", "form_date", "rater")


@query(CELLS + """SELECT variable, round(avg(CAST(value NOT IN ('', '-9', '1909-09-09') AND try_cast(value AS DOUBLE) IS NOT NULL AS INTEGER)) / avg(CAST(value NOT IN ('', '-9', '1909-09-09') AS INTEGER)), 6) AS share FROM long GROUP BY 1
 HAVING avg(CAST(value NOT IN ('', '-9', '1909-09-09') AND try_cast(value AS DOUBLE) IS NOT NULL AS INTEGER)) / avg(CAST(value NOT IN ('', '-9', '1909-09-09') AS INTEGER)) > 0.6""")
def q_variables_of_type(spark, sf_dir):
    """A4 over A3."""
    long = rules.long_form(part_cells(spark, sf_dir), ["p_partkey"], ["size", "mixed"])
    return discovery.variables_of_type(discovery.type_distribution(long), "number", 0.6).select("variable", F.round("share", 6).alias("share"))


@query(CELLS + """, f AS (SELECT p_partkey, unnest(CASE WHEN size = '' THEN ['Main Report', 'Blood Report'] ELSE ['Main Report'] END) AS report FROM cells WHERE size IN ('', '-9'))
 SELECT report, count(*) AS n, min(p_partkey) AS least FROM f GROUP BY 1""")
def q_reports(spark, sf_dir):
    """The flags of each report by its name."""
    blank = F.when(F.col("size") == "", F.array(F.lit("Main Report"), F.lit("Blood Report"))).otherwise(F.array(F.lit("Main Report")))
    found = part_cells(spark, sf_dir).where("size IN ('', '-9')").select("p_partkey", blank.alias("reports"))
    return flags.of_reports(found).groupBy("report").agg(F.count("*").alias("n"), F.min("p_partkey").alias("least"))


@query("SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS changes FROM lineitem GROUP BY 1")
def q_changes_per_day(spark, sf_dir):
    """A9."""
    return tracker.changes_per_day(t(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")))


@query("SELECT 'v' || p_partkey || '_date' AS variable FROM part WHERE p_size % 4 = 0 AND p_size % 3 <> 0")
def q_undeclared_dates(spark, sf_dir):
    """A17."""
    name = F.concat(F.lit("v"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 4 == 0, "_date").otherwise("_x"))
    return discovery.undeclared_dates(t(spark, sf_dir, "part").select(name.alias("variable"), F.when(F.col("p_size") % 3 == 0, "date_ymd").when(F.col("p_size") % 3 == 1, "").alias("validation")))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS a, CAST(CAST(l_shipdate AS DATE) + CAST(l_linenumber * 20 - 60 AS INTEGER) AS DATE) AS b, CAST(CAST(l_shipdate AS DATE) + CAST((l_orderkey % 3) * 30 - 30 AS INTEGER) AS DATE) AS c FROM lineitem),
 d AS (SELECT l_orderkey, l_linenumber, list_max(list_filter([{'d': a, 'n': 'shipped'}, {'d': b, 'n': 'due'}, {'d': c, 'n': 'billed'}], lambda x: x.d <= DATE '1996-01-01')) AS r FROM l)
 SELECT l_orderkey, l_linenumber, r.d AS date, r.n AS name FROM d WHERE r IS NOT NULL""")
def q_recent_date(spark, sf_dir):
    """The latest of three dates that isn't after the run; of equal ones the last by name."""
    made = {"shipped": "to_date(l_shipdate)", "due": "date_add(to_date(l_shipdate), CAST(l_linenumber * 20 - 60 AS int))", "billed": "date_add(to_date(l_shipdate), CAST((l_orderkey % 3) * 30 - 30 AS int))"}
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.expr(e).alias(x) for x, e in made.items()])
    found = subjects.recent_date(list(made), F.lit("1996-01-01").cast("date"))
    return rows.select("l_orderkey", "l_linenumber", found.alias("r")).where("r IS NOT NULL").select("l_orderkey", "l_linenumber", "r.*")


@query("SELECT 'v' || p_partkey AS variable FROM part WHERE p_size > 25")
def q_new_variables(spark, sf_dir):
    """J10."""
    variables = t(spark, sf_dir, "part").select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("variable"), "p_size")
    return diffs.new_variables(variables.select("variable"), variables.where("p_size <= 25").select("variable"))


@query(CELLS + """, a AS (SELECT p_partkey, p_brand, variable, value FROM long WHERE p_partkey % 4 <> 1 AND p_partkey % 3 <> 1 AND NOT (variable = 'mixed' AND p_partkey % 2 = 0))
 SELECT p_brand, variable, value, CASE WHEN p_partkey % 6 = 0 THEN 'blank though applicable' ELSE 'filled though not applicable' END AS side, count(*) AS count FROM a WHERE (p_partkey % 6 = 0) = (value = '') GROUP BY 1, 2, 3, 4""")
def q_audited_cells(spark, sf_dir):
    """F10 before A18: marked missing, not complete, excluded and (in one network) identifying cells, and names that aren't audited, take no part."""
    long = rules.long_form(part_cells(spark, sf_dir).withColumns({"size_err": F.lit("1"), "unmapped": F.lit("1"), "barred": F.lit("1")}), ["p_partkey", "p_brand"], ["size", "mixed", "size_err", "unmapped", "barred"])
    k = F.col("p_partkey")
    long = long.withColumns({"missing": F.when(k % 4 == 1, "1").when(k % 4 == 2, "0"), "complete": F.when(k % 3 == 0, "2").when(k % 3 == 1, "0"), "network": F.when(k % 2 == 0, "PRONET").otherwise("PRESCIENT"), "applies": k % 6 == 0})
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "variable string")
    cells = discovery.auditable(long, names("size", "mixed", "size_err", "barred"), names("barred"), names("mixed"))
    return discovery.applicability_audit(cells, ["p_brand"], "p_partkey").select("p_brand", "variable", "value", "side", "count")


@query("""WITH s AS (SELECT l_linenumber AS k, avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem GROUP BY 1),
 z AS (SELECT l_suppkey, l_linenumber, abs(l_quantity - m) / sd AS z, l_discount * 20 AS d FROM lineitem JOIN s ON k = l_linenumber WHERE sd > 0),
 g AS (SELECT l_suppkey, count(*) AS n, sum(z) AS gt, array_to_string(list_sort(list(CAST(l_linenumber AS VARCHAR))), ',') AS pairs FROM z WHERE z > 1.2 OR d > 1.5 GROUP BY 1)
 SELECT l_suppkey, n, round(gt, 4) AS global_total, pairs FROM g JOIN supplier ON s_suppkey = l_suppkey WHERE n > 5 AND s_acctbal > 0""")
def q_kept_scores(spark, sf_dir):
    """A27 with its rule for pairs that deviate, and the pairs that contribute."""
    lines = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_discount", F.col("l_quantity").alias("value"))
    scored = discovery.z_scores(lines, ["l_linenumber"])
    # both bounds as multiples of one
    kept = scored.where("z > 1.2 OR l_discount * 20 > 1.5").select("l_suppkey", (F.col("z") / 1.2).alias("g"), (F.col("l_discount") * 20 / 1.5).alias("local_deviation"), F.col("l_linenumber").cast("string").alias("pair"))
    every = kept.unionByName(scored.where("NOT (z > 1.2 OR l_discount * 20 > 1.5)").select("l_suppkey", (F.col("z") / 1.2).alias("g"), (F.col("l_discount") * 20 / 1.5).alias("local_deviation"), F.lit("none").alias("pair")))
    outliers = t(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("z"))
    found = discovery.final_scores(every.withColumnRenamed("g", "global_deviation"), outliers, ["l_suppkey"])
    return found.select("l_suppkey", "n", F.round(F.col("global_total") * 1.2, 4).alias("global_total"), F.array_join("pairs", ",").alias("pairs"))


@query("""WITH o AS (SELECT o_custkey, max(CASE WHEN year(o_orderdate) = 1995 THEN o_orderkey % 60 END) AS s, max(CASE WHEN year(o_orderdate) = 1996 THEN o_orderkey % 60 END) AS b FROM orders GROUP BY 1)
 SELECT CAST(o_custkey AS VARCHAR) AS subjectid, 'baseline' AS timepoint, 'chrpps_mage_baseline : chrfigs_mother_age_screening is equal to ' || s || ', but chrpps_mage_baseline is equal to ' || b AS error_message FROM o WHERE s <> b AND b IS NOT NULL""")
def q_run_parents(spark, sf_dir):
    """R52 in a run: the mother's age at screening and at baseline; both forms pass at their own visits."""
    names = ("variable", "form", "field_type", "label", "choices", "branching_logic", "required", "identifier", "validation", "validation_min", "validation_max")
    forms = ("psychosis_polyrisk_score", "family_interview_for_genetic_studies_figs")
    made = [(x, f, "text", "", "", "", "", "", "", "", "") for x, f in zip(("chrpps_mage", "chrfigs_mother_age"), forms, strict=True)]
    of = run.study(spark.createDataFrame(made, ", ".join(f"{x} string" for x in names)))
    age = F.max(F.col("o_orderkey") % 60).cast("string")
    years = t(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(age.alias("age")).where("y IN (1995, 1996)")
    early = F.col("y") == 1995
    rows = years.select(
        F.col("o_custkey").cast("string").alias("subjectid"), F.lit("PRONET").alias("network"), F.when(early, "screening").otherwise("baseline").alias("timepoint"), F.lit("month2").alias("visit_status_string"),
        F.when(early, F.col("age")).alias("chrfigs_mother_age"), F.when(~early, F.col("age")).alias("chrpps_mage"), *[F.lit("2").alias(f"{f}_complete") for f in forms],
    )
    info = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("subject"), F.lit("included").alias("inclusion_status"), F.lit("CHR").alias("cohort"), F.lit("20").alias("age"))
    due = spark.createDataFrame([("CHR", "screening", [forms[1]]), ("CHR", "baseline", [forms[0]])], "cohort string, timepoint string, forms array<string>")
    found = run.checked(run.with_subjects(rows, info, model.timepoints(spark)), of, due, F.lit("1999-01-01").cast("date")).flags
    return found.where("rule = 'ages chrpps_mage_baseline'").select("subjectid", "timepoint", "error_message")



"""The engine's operators as queries over the driver's tables, each with the same result in SQL.

Roles: subject = customer, network = region, site = nation, cohort = market segment, timepoint = year of the order, completion = order status, measurements = lineitem numbers;
flags over time = events.  Blank and coded cells don't occur in the tables, so both sides derive them from part sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import predicates
from tallyward.functions import values as v
from tallyward.functions.expressions import col
from tallyward.functions.values import of_text as cell
from tallyward.operators import catalog, diffs, discovery, gate, lifecycle, rules, subjects, tracker
from tallyward.operators.flags import flag_records, piped
from tallyward.plans import dictionary as dd
from tallyward.plans import model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_cells(spark, sf_dir) -> DataFrame:
    """Parts as form rows: text cells with blanks, missing codes, numbers, dates and words."""
    size = F.when(F.col("p_size") % 10 == 0, "").when(F.col("p_size") % 10 == 1, "-9").otherwise(F.col("p_size").cast("string"))
    mixed = F.when(F.col("p_partkey") % 5 == 0, "2024-01-05").when(F.col("p_partkey") % 5 == 1, F.col("p_type")).when(F.col("p_partkey") % 5 == 2, "1909-09-09").otherwise((F.col("p_partkey") % 100).cast("string"))
    return t(spark, sf_dir, "part").select("p_partkey", "p_brand", size.alias("size"), mixed.alias("mixed"))


CELLS = """WITH cells AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 10 = 1 THEN '-9' ELSE CAST(p_size AS VARCHAR) END AS size,
 CASE WHEN p_partkey % 5 = 0 THEN '2024-01-05' WHEN p_partkey % 5 = 1 THEN p_type WHEN p_partkey % 5 = 2 THEN '1909-09-09' ELSE CAST(p_partkey % 100 AS VARCHAR) END AS mixed FROM part),
 long AS (SELECT p_partkey, p_brand, 'size' AS variable, size AS value FROM cells UNION ALL SELECT p_partkey, p_brand, 'mixed', mixed FROM cells) """


def long_cells(spark, sf_dir) -> DataFrame:
    return rules.long_form(part_cells(spark, sf_dir), ["p_partkey", "p_brand"], ["size", "mixed"])


def lines_with_orders(spark, sf_dir) -> DataFrame:
    day = lambda x: F.date_format(x, "yyyy-MM-dd")
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", day("l_shipdate").alias("ship"))
    orders = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", day("o_orderdate").alias("ordered"))
    return lines.join(orders, "l_orderkey")


LINES = """WITH lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, strftime(l_shipdate, '%Y-%m-%d') AS ship, strftime(o_orderdate, '%Y-%m-%d') AS ordered, o_custkey
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey) """


@query(CELLS + "SELECT p_partkey, p_brand, variable, value, 'part' AS form, 'Main Report' AS report, 'Variable is blank.' AS error_message FROM long WHERE value = ''")
def q_blank_check(spark, sf_dir):
    table = spark.createDataFrame([("size", "part", "Main Report"), ("mixed", "part", "Main Report")], "variable string, form string, report string")
    return rules.blank_checks(long_cells(spark, sf_dir), F.broadcast(table))


@query(CELLS + "SELECT p_partkey, p_brand, variable, value, 'Variable is a missing code (value = ' || value || ').' AS error_message FROM long WHERE value IN ('-9', '-3', '-99', '999', '1909-09-09', '1903-03-03', '1901-01-01')")
def q_missing_code(spark, sf_dir):
    table = spark.createDataFrame([("size",), ("mixed",)], "variable string")
    return rules.missing_code_checks(long_cells(spark, sf_dir), F.broadcast(table))


@query("""WITH long AS (SELECT o_orderkey, 'priority' AS variable, substr(o_orderpriority, 1, 1) AS value FROM orders
 UNION ALL SELECT o_orderkey, 'class', CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR) FROM orders)
 SELECT o_orderkey, variable, value FROM long WHERE (variable = 'priority' AND value IN ('1', '2')) OR (variable = 'class' AND value NOT IN ('0', '1'))""")
def q_specific_value(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    cells = orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"), F.floor(F.col("o_totalprice") / 100000).cast("string").alias("class"))
    table = spark.createDataFrame([("priority", [1.0, 2.0], False, "Priority"), ("class", [0.0, 1.0], True, "Class")], "variable string, codes array<double>, negate boolean, message string")
    return rules.specific_value_checks(rules.long_form(cells, ["o_orderkey"], ["priority", "class"]), F.broadcast(table)).select("o_orderkey", "variable", "value")


RANGES = [("l_quantity", 2.0, 45.0), ("l_discount", 0.01, 0.09), ("l_tax", 0.0, 0.07)]


@query("""WITH long AS (SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity + 0.0 AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount + 0.0 FROM lineitem
 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax + 0.0 FROM lineitem), limits(variable, low, high) AS (VALUES ('l_quantity', 2.0, 45.0), ('l_discount', 0.01, 0.09), ('l_tax', 0.0, 0.07))
 SELECT l_orderkey, l_linenumber, variable, value FROM long JOIN limits USING (variable) WHERE value < CAST(low AS DOUBLE) OR value > CAST(high AS DOUBLE)""")
def q_range_check(spark, sf_dir):
    long = rules.long_form(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [x for x, _, _ in RANGES])
    table = spark.createDataFrame(RANGES, "variable string, low double, high double")
    return rules.range_checks(long, F.broadcast(table)).select("l_orderkey", "l_linenumber", "variable", (v.num("value") + F.lit(0.0)).alias("value"))


@query("""WITH c AS (SELECT o_custkey AS subjectid, CAST(year(o_orderdate) AS INTEGER) AS timepoint, min(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END) AS status FROM orders GROUP BY 1, 2)
 SELECT subjectid, timepoint, 'order' AS form, 'Form is not marked as complete, but the subject has moved on.' AS error_message FROM c
 WHERE status <> 2 AND EXISTS (SELECT 1 FROM c d WHERE d.subjectid = c.subjectid AND d.timepoint > c.timepoint)""")
def q_completion(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subjectid"), F.year("o_orderdate").alias("timepoint"), F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("code"))
    visits = orders.groupBy("subjectid", "timepoint").agg(F.min("code").cast("string").alias("status"))
    last = visits.groupBy("subjectid").agg(F.max("timepoint").alias("visit_ordinal"))
    people = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subjectid"), F.lit("REGION").alias("network"), F.col("c_mktsegment").alias("cohort"))
    rows = visits.select("subjectid", "timepoint", F.col("timepoint").alias("ordinal")).join(last, "subjectid").join(people, "subjectid")
    due = rows.select("cohort", "timepoint").distinct().withColumn("forms", F.array(F.lit("order")))
    completions = visits.select("subjectid", "timepoint", F.lit("order").alias("form"), "status")
    return gate.completion_checks(rows, due, completions).select("subjectid", "timepoint", "form", "error_message")


@query("""SELECT c_custkey, 'even name' AS rule, 'c_name : Name does not end in an even digit (' || c_name || ')' AS error_message FROM customer WHERE NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$')
 UNION ALL SELECT c_custkey, 'segment', 'c_mktsegment : Segment has an R (' || c_mktsegment || ')' FROM customer WHERE NOT regexp_matches(c_mktsegment, '^[A-QS-Z]+$')""")
def q_text_pattern(spark, sf_dir):
    checks = [rules.pattern("even name", "c_name", "^Customer#[0-9]*[02468]$", "Name does not end in an even digit"), rules.pattern("segment", "c_mktsegment", "^[A-QS-Z]+$", "Segment has an R")]
    return rules.evaluate(t(spark, sf_dir, "customer"), checks, ["c_custkey"]).select("c_custkey", "rule", "error_message")


@query(LINES + "SELECT l_orderkey, l_linenumber, 'ordered : ordered (' || ordered || ') is later than ship (' || ship || ')' AS error_message FROM lines WHERE ordered > ship")
def q_date_order(spark, sf_dir):
    return rules.evaluate(lines_with_orders(spark, sf_dir), [rules.ordered("ship after order", "ordered", "ship")], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "error_message")


@query("""SELECT l_orderkey, l_linenumber, 'returned' AS rule FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'F' UNION ALL
 SELECT l_orderkey, l_linenumber, 'discount' FROM lineitem WHERE l_discount > 0.05 AND NOT l_quantity > 25 UNION ALL SELECT l_orderkey, l_linenumber, 'tax' FROM lineitem WHERE l_tax = 0 AND l_linestatus = 'O'""")
def q_implication(spark, sf_dir):
    checks = [
        rules.implies("returned", ("l_returnflag", "l_linestatus"), col("l_returnflag") == "R", col("l_linestatus") == "F", "returned, but open"),
        rules.implies("discount", ("l_discount", "l_quantity"), col("l_discount") > 0.05, col("l_quantity") > 25, "discount on a small quantity"),
        rules.implies("tax", ("l_tax", "l_linestatus"), cell.is_code("l_tax", 0), col("l_linestatus") != "O", "no tax on an open line"),
    ]
    return rules.evaluate(t(spark, sf_dir, "lineitem"), checks, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "rule")


@query("""WITH s AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS parts FROM lineitem GROUP BY 1)
 SELECT o_orderkey, o_totalprice AS total, parts FROM orders JOIN s ON l_orderkey = o_orderkey WHERE parts < o_totalprice - 0.1::DOUBLE * o_totalprice OR parts > o_totalprice + 0.1::DOUBLE * o_totalprice""")
def q_tolerance(spark, sf_dir):
    cents = F.round(F.sum("l_extendedprice") * 100) / 100  # of the double, as SQL does; F.round with places rounds its shortest text
    sums = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(cents.alias("parts"))
    rows = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("total")).join(sums, "o_orderkey")
    return rules.evaluate(rows, [rules.tolerance("sum", "total", "parts", 0.1, read=cell.num)], ["o_orderkey", "total", "parts"]).select("o_orderkey", "total", "parts")


@query("""SELECT l_orderkey, l_linenumber, 'extreme l_discount' AS rule FROM lineitem WHERE l_discount > least(l_tax, l_quantity / 500) UNION ALL SELECT l_orderkey, l_linenumber, 'extreme l_tax' FROM lineitem WHERE l_tax < greatest(l_discount, l_quantity / 500)""")
def q_score_extreme(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").withColumn("share", F.col("l_quantity") / 500)
    checks = [catalog.extreme("l_discount", ("l_tax", "share"), "line", lowest=True), catalog.extreme("l_tax", ("l_discount", "share"), "line", lowest=False)]
    return rules.evaluate(rows, checks, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "rule")


@query(LINES + "SELECT l_orderkey, l_linenumber, abs(date_diff('day', CAST(ordered AS DATE), CAST(ship AS DATE))) AS days FROM lines WHERE abs(date_diff('day', CAST(ordered AS DATE), CAST(ship AS DATE))) > 21")
def q_day_gap(spark, sf_dir):
    rows = lines_with_orders(spark, sf_dir)
    found = rules.evaluate(rows, [rules.gap("late", "ordered", "ship", 21)], ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber", v.first_digits("error_message").cast("long").alias("days"))


@query("""WITH s AS (SELECT DISTINCT l_orderkey, CAST(l_suppkey AS VARCHAR) AS name, l_linenumber AS slot FROM lineitem)
 SELECT a.l_orderkey, a.name, a.slot AS slot_1, b.slot AS slot_2 FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.name = b.name AND a.slot < b.slot""")
def q_in_row_duplicates(spark, sf_dir):
    filled = t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").cast("string").alias("name"), F.col("l_linenumber").alias("slot")).distinct()
    return rules.repeated_in_slots(filled, ["l_orderkey"], "name")


@query("""WITH s AS (SELECT user_id, event_type, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2)
 SELECT x.user_id, x.event_type AS event_type_1, y.event_type AS event_type_2 FROM s x JOIN s y ON x.user_id = y.user_id AND x.event_type < y.event_type AND x.a <= y.b AND y.a <= x.b""")
def q_interval_overlap(spark, sf_dir):
    spans = t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return rules.overlapping(spans, ["user_id"], "a", "b", "event_type")


def yearly(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject"), F.year("o_orderdate").alias("visit"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("l_orderkey"))


@query("""WITH r AS (SELECT o_custkey AS subject, CAST(year(o_orderdate) AS INTEGER) AS visit, CAST(min(o_orderdate) AS DATE) AS earliest, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1, 2),
 p AS (SELECT *, lag(visit) OVER w AS pv, lag(earliest) OVER w AS pe, lag(latest) OVER w AS pl FROM r WINDOW w AS (PARTITION BY subject ORDER BY visit)),
 s AS (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS d1, CAST(max(l_shipdate) AS DATE) AS d2 FROM lineitem GROUP BY 1)
 SELECT o_orderkey AS l_orderkey, d1, d2 FROM orders JOIN s ON l_orderkey = o_orderkey JOIN p ON subject = o_custkey AND visit = year(o_orderdate)
 WHERE (visit = 1992 OR pv = visit - 1) AND (d1 < least(earliest, pe) OR d1 > greatest(latest, pl)) AND (d2 < least(earliest, pe) OR d2 > greatest(latest, pl))""")
def q_visit_range(spark, sf_dir):
    visits = yearly(spark, sf_dir)
    ranges = subjects.visit_ranges(visits, ["subject", "visit"]).withColumn("ordinal", F.col("visit") - 1992)
    ships = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("d1"), F.to_date(F.max("l_shipdate")).alias("d2"))
    rows = visits.join(ships, "l_orderkey")
    return subjects.outside_visits(rows, ranges, "subject", "visit", "ordinal", ["d1", "d2"]).select("l_orderkey", "d1", "d2")


@query("""SELECT o_custkey AS subjectid, CAST(count(*) FILTER (year(o_orderdate) = 1995) AS BIGINT) AS n_1995, CAST(count(*) FILTER (year(o_orderdate) = 1996) AS BIGINT) AS n_1996 FROM orders GROUP BY 1
 HAVING count(*) FILTER (year(o_orderdate) = 1995) > 0 AND count(*) FILTER (year(o_orderdate) = 1996) > 0 AND count(*) FILTER (year(o_orderdate) = 1995) <> count(*) FILTER (year(o_orderdate) = 1996)""")
def q_cross_timepoint(spark, sf_dir):
    counts = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("subjectid"), F.year("o_orderdate").alias("timepoint")).agg(F.count("*").alias("n"))
    wide = model.wide_subjects(counts, ["n"], (1995, 1996)).select("subjectid", F.col("1995").alias("n_1995"), F.col("1996").alias("n_1996"))
    return wide.where("n_1995 != n_1996")


@query(CELLS + """, a AS (SELECT p_brand, p_partkey, size AS value, CASE WHEN mixed <> '' AND coalesce(try_cast(mixed AS DOUBLE) > 20, false) THEN true ELSE false END AS applies FROM cells)
 SELECT p_brand, 'size' AS variable, value, CASE WHEN applies THEN 'blank though applicable' ELSE 'filled though not applicable' END AS side, count(*) AS "count",
 array_to_string(list_slice(list_sort(list(DISTINCT p_partkey)), 1, 50), ',') AS subjects FROM a WHERE applies = (value = '') GROUP BY 1, 2, 3, 4""")
def q_applicability_audit(spark, sf_dir):
    cells = part_cells(spark, sf_dir)
    text = spark.createDataFrame([("size", "[mixed]<>'' and [mixed]>'20'")], "variable string, branching_logic string")
    predicate = predicates.compiled(text).first()["predicate"]
    long = cells.select("p_brand", "p_partkey", F.lit("size").alias("variable"), F.col("size").alias("value"), F.expr(predicates.applicable(predicate, cells.columns).text).alias("applies"))
    audit = discovery.applicability_audit(long, ["p_brand"], "p_partkey")
    return audit.select("p_brand", "variable", "value", "side", "count", F.array_join(F.transform("subjects", lambda x: x.cast("string")), ",").alias("subjects"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS subject, n_name, r_name, CASE WHEN c_nationkey % 3 = 0 THEN 'excluded' WHEN c_nationkey % 3 = 1 THEN 'included' ELSE 'unknown' END AS inclusion_status,
 CASE WHEN c_custkey % 3 = 1 THEN 'CHR' WHEN c_custkey % 3 = 2 THEN 'HC' ELSE 'unknown' END AS cohort, CASE WHEN c_acctbal >= 0 THEN round(floor(c_acctbal / 10) / 12, 2) END AS age
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_subject_info(spark, sf_dir):
    place = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = t(spark, sf_dir, "customer").join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("subjectid", F.col("c_custkey").cast("string"))
    no = F.lit("")
    screening = people.select("subjectid", (F.col("c_nationkey") % 3).cast("string").alias("chrcrit_included"), (F.col("c_custkey") % 3).cast("string").alias("chrcrit_part"), F.col("c_mktsegment").alias("visit_status_string"), no.alias("chrpsychs_scr_interview_date"), no.alias("chric_actigraphy"), no.alias("chric_passive"))
    baseline = people.select("subjectid", F.floor(F.col("c_acctbal") / 10).cast("string").alias("chrdemo_age_mos_chr"), no.alias("chrdemo_age_mos_hc"), no.alias("chrdemo_age_mos2"), no.alias("chrdemo_sexassigned"), no.alias("chrdemo_interview_date"))
    baseline = baseline.withColumn("chrdemo_age_mos_chr", F.when(F.col("chrdemo_age_mos_chr") == "999", "999.0001").otherwise(F.col("chrdemo_age_mos_chr")))
    floating = people.select("subjectid", no.alias("chr_statusform_screenfail"), no.alias("chr_subject_eos"))
    info = model.subject_info(screening, baseline, floating)
    return info.join(people.select(F.col("subjectid").alias("subject"), "n_name", "r_name"), "subject").select("subject", "n_name", "r_name", "inclusion_status", "cohort", v.num("age").alias("age"))


VISITS = ("screening", "baseline", "month1", "month2", "month3", "month4", "month5", "month6")


@query("""WITH l AS (SELECT o_custkey, max(year(o_orderdate)) - 1992 AS k, CAST(max(o_orderdate) AS DATE) AS most_recent_date FROM orders GROUP BY 1)
 SELECT o_custkey AS subject, CASE k WHEN 0 THEN 'screening' WHEN 1 THEN 'baseline' ELSE 'month' || CAST(k - 1 AS VARCHAR) END AS current_timepoint, most_recent_date,
 CAST(CASE WHEN k = 3 AND c_custkey % 2 = 0 THEN 300 ELSE 30 END - date_diff('day', most_recent_date, DATE '1999-01-01') AS BIGINT) AS days_until_expected_next_visit FROM l JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0""")
def q_withdrawal(spark, sf_dir):
    dimension = model.timepoints(spark).select("timepoint", "ordinal")
    visits = subjects.visit_ranges(yearly(spark, sf_dir), ["subject", "visit"]).withColumn("ordinal", F.col("visit") - 1992).join(F.broadcast(dimension), "ordinal")
    info = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject"), F.when(F.col("c_custkey") % 2 == 0, "HC").otherwise("CHR").alias("cohort"), F.when(F.col("c_acctbal") > 0, "included").otherwise("excluded").alias("inclusion_status"), F.lit(False).alias("screenfail"), F.lit(False).alias("completed_study"))
    found = subjects.withdrawals(visits, info, F.lit("1999-01-01").cast("date"))
    return found.select("subject", "current_timepoint", "most_recent_date", F.col("days_until_expected_next_visit").cast("long").alias("days_until_expected_next_visit"))


@query("""WITH d AS (SELECT o_custkey AS subject, 'order' AS form, CAST(o_orderdate AS DATE) AS date FROM orders UNION ALL SELECT o_custkey, 'ship', CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
 SELECT subject, max(date) AS latest_date, min(form) FILTER (WHERE date = m) AS latest_form FROM (SELECT *, max(date) OVER (PARTITION BY subject) AS m FROM d) JOIN customer ON c_custkey = subject
 WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING' GROUP BY 1""")
def q_latest_date(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    lines = t(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    dates = orders.select(F.col("o_custkey").alias("subject"), F.lit("order").alias("form"), F.to_date("o_orderdate").alias("date")).unionByName(lines.select(F.col("o_custkey").alias("subject"), F.lit("ship").alias("form"), F.to_date("l_shipdate").alias("date")))
    info = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject"), F.when(F.col("c_acctbal") < 0, "excluded").otherwise("included").alias("inclusion_status"), F.col("c_mktsegment").alias("visit_status"))
    found = subjects.excluded_beyond(info, subjects.latest_dates(dates, "subject", "date", "form"), screening=("BUILDING",))
    return found.where("latest_date is not null").select("subject", "latest_date", "latest_form")


@query(CELLS + """SELECT variable, count(*) FILTER (value IN ('-9', '-3', '-99', '999', '1909-09-09')) AS n_missing, count(*) FILTER (value NOT IN ('-9', '-3', '-99', '999') AND try_cast(value AS DOUBLE) IS NOT NULL) AS n_number,
 count(*) FILTER (value = '2024-01-05') AS n_date, count(*) FILTER (value = '') AS n_blank, count(*) FILTER (value NOT IN ('-9', '1909-09-09', '2024-01-05', '') AND try_cast(value AS DOUBLE) IS NULL) AS n_text, CAST(0 AS BIGINT) AS n_other FROM long GROUP BY 1""")
def q_type_distribution(spark, sf_dir):
    return discovery.type_distribution(long_cells(spark, sf_dir))


@query("SELECT event_type, CAST(min(ts) AS DATE) AS earliest FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-03' GROUP BY 1")
def q_earliest_use(spark, sf_dir):
    return discovery.earliest_use(t(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("date")), "event_type", "date", F.lit("2024-01-03").cast("date"))


@query("""WITH m AS (SELECT c_mktsegment, median(c_acctbal) FILTER (r_name = 'AFRICA') AS a, median(c_acctbal) FILTER (r_name = 'ASIA') AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
 SELECT c_mktsegment, round(a, 6) AS median_0, round(b, 6) AS median_1, round(CASE WHEN a IS NULL OR b IS NULL OR a + b = 0 THEN 0 ELSE abs(a - b) / ((a + b) / 2) * 100 END, 6) AS difference FROM m""")
def q_median_compare(spark, sf_dir):
    place = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t(spark, sf_dir, "customer").join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "r_name", F.col("c_acctbal").alias("value"))
    found = discovery.median_compare(rows, "r_name", ("AFRICA", "ASIA"), ["c_mktsegment"])
    return found.select("c_mktsegment", *[F.round(x, 6).alias(x) for x in ("median_0", "median_1", "difference")])


@query("""WITH s AS (SELECT year(l_shipdate) AS y, count(*) AS n, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS std, median(l_extendedprice) AS med FROM lineitem GROUP BY 1 HAVING count(*) > 50)
 SELECT CAST(s.y AS INTEGER) AS y, n, round(med, 4) AS median, count(*) FILTER (abs(mean - l_extendedprice) / std > 1.5) AS beyond, round(max(abs(mean - l_extendedprice) / std), 6) AS largest
 FROM lineitem JOIN s ON year(l_shipdate) = s.y GROUP BY s.y, n, med""")
def q_zscore(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y"), F.col("l_extendedprice").alias("value"))
    scored = discovery.z_scores(rows, ["y"], least=50)
    return scored.groupBy("y", "n", F.round("median", 4).alias("median")).agg(F.count_if(F.col("z") > 1.5).alias("beyond"), F.round(F.max("z"), 6).alias("largest"))


@query("""WITH s AS (SELECT event_type, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std FROM events WHERE value IS NOT NULL GROUP BY 1)
 SELECT event_id, event_type, value FROM events JOIN s USING (event_type) WHERE n >= 10 AND mean >= 3 AND abs(value - mean) > 2 * std""")
def q_three_sigma(spark, sf_dir):
    return discovery.deviations(t(spark, sf_dir, "events"), ["event_type"], times=2).select("event_id", "event_type", "value")


@query("""WITH s AS (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS std FROM events GROUP BY 1), z AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, ts, event_id, abs(mean - value) / std AS z FROM events JOIN s USING (event_type) WHERE std > 0),
 e AS (SELECT *, coalesce(sum(CAST(z > 2 AS INTEGER)) OVER (PARTITION BY user_id, d, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
 coalesce(sum(CAST(z > 2 AS INTEGER)) OVER (PARTITION BY user_id, d ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS form_n FROM z),
 f AS (SELECT *, coalesce(sum(CASE WHEN z > 2 AND earlier = 0 THEN 0.25 * ln(z) ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lv FROM e)
 SELECT user_id, round(avg(pow(z, 0.75) * pow(0.5, form_n) * exp(lv)), 6) AS score, count(*) AS n FROM f GROUP BY 1""")
def q_rater_score(spark, sf_dir):
    scored = discovery.z_scores(t(spark, sf_dir, "events").withColumn("d", F.to_date("ts")), ["event_type"])
    scored = scored.withColumn("rater", F.col("user_id").cast("string")).withColumn("all", F.lit("all"))
    found = discovery.rater_scores(scored, "rater", "d", "all", "event_type", "z", ["ts", "event_id"])
    return found.select(F.col("rater").cast("long").alias("user_id"), F.round("score", 6).alias("score"), "n")


PAIRS = ("l_linenumber", "l_quantity", "discount", "tax", "supplier")


@query("""WITH c AS (SELECT l_linenumber, l_quantity, round(l_discount * 100) AS discount, round(l_tax * 100) AS tax, l_suppkey % 10 AS supplier FROM lineitem), p AS (
 SELECT 'l_linenumber' AS variable_1, 'discount' AS variable_2, avg(CAST(l_linenumber = discount AS INTEGER)) AS share FROM c UNION ALL SELECT 'l_linenumber', 'l_quantity', avg(CAST(l_linenumber = l_quantity AS INTEGER)) FROM c UNION ALL
 SELECT 'l_linenumber', 'tax', avg(CAST(l_linenumber = tax AS INTEGER)) FROM c UNION ALL SELECT 'l_linenumber', 'supplier', avg(CAST(l_linenumber = supplier AS INTEGER)) FROM c UNION ALL SELECT 'l_quantity', 'discount', avg(CAST(l_quantity = discount AS INTEGER)) FROM c UNION ALL
 SELECT 'l_quantity', 'tax', avg(CAST(l_quantity = tax AS INTEGER)) FROM c UNION ALL SELECT 'l_quantity', 'supplier', avg(CAST(l_quantity = supplier AS INTEGER)) FROM c UNION ALL SELECT 'discount', 'tax', avg(CAST(discount = tax AS INTEGER)) FROM c UNION ALL
 SELECT 'discount', 'supplier', avg(CAST(discount = supplier AS INTEGER)) FROM c UNION ALL SELECT 'tax', 'supplier', avg(CAST(tax = supplier AS INTEGER)) FROM c) SELECT variable_1, variable_2, round(share, 6) AS share FROM p WHERE share > 0.05""")
def q_pair_equality(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity", F.round(F.col("l_discount") * 100).alias("discount"), F.round(F.col("l_tax") * 100).alias("tax"), (F.col("l_suppkey") % 10).alias("supplier"))
    found = discovery.equal_pairs(rows.select(*[F.col(x).cast("string").alias(x) for x in PAIRS]), list(PAIRS), share=0.05)
    return found.withColumn("share", F.round("share", 6))


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS ordered, CAST(l_shipdate AS DATE) AS ship, CASE WHEN l_linenumber > 1 THEN CAST(o_orderdate AS DATE) + 30 END AS due FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 p AS (SELECT 'ordered' AS "first", 'ship' AS "second", ordered AS a, ship AS b FROM d UNION ALL SELECT 'ship', 'ordered', ship, ordered FROM d UNION ALL SELECT 'ordered', 'due', ordered, due FROM d UNION ALL SELECT 'due', 'ordered', due, ordered FROM d
 UNION ALL SELECT 'ship', 'due', ship, due FROM d UNION ALL SELECT 'due', 'ship', due, ship FROM d)
 SELECT "first", "second", count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS total, count(*) FILTER (a > b) AS later, round(count(*) FILTER (a > b) / count(*) FILTER (a IS NOT NULL AND b IS NOT NULL), 6) AS share FROM p GROUP BY 1, 2""")
def q_date_pairs(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(F.to_date("o_orderdate").alias("ordered"), F.to_date("l_shipdate").alias("ship"), F.when(F.col("l_linenumber") > 1, F.date_add(F.to_date("o_orderdate"), 30)).alias("due"))
    return discovery.date_pairs(rows, ["ordered", "ship", "due"]).withColumn("share", F.round("share", 6))


@query("""WITH s AS (SELECT p_brand AS grp, median(p_size) AS mx, stddev_samp(p_size) AS sx, median(p_retailprice) AS my, stddev_samp(p_retailprice) AS sy FROM part GROUP BY 1),
 p AS (SELECT p_brand AS grp, p_partkey AS id, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part JOIN s ON grp = p_brand WHERE abs(p_size - mx) <= 2.5 * sx AND abs(p_retailprice - my) <= 2.5 * sy),
 q AS (SELECT * FROM p WHERE grp IN (SELECT grp FROM p GROUP BY 1 HAVING count(*) >= 50)),
 d AS (SELECT a.grp, a.id, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM q a JOIN q b ON a.grp = b.grp),
 r AS (SELECT *, row_number() OVER (PARTITION BY grp, id ORDER BY d) AS k FROM d)
 SELECT grp, id, round(sum(d), 4) AS "global", round(sum(d) FILTER (k <= 5), 4) AS "local" FROM r GROUP BY 1, 2""")
def q_pair_deviation(spark, sf_dir):
    points = t(spark, sf_dir, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return discovery.pair_deviation(points).select("grp", "id", F.round("global", 4).alias("global"), F.round("local", 4).alias("local"))


@query("""WITH p AS (SELECT DISTINCT o_custkey AS subject, CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey NOT IN (-9, -3, -99, 999) AND l_suppkey NOT IN (-9, -3, -99, 999)),
 s AS (SELECT value, count(*) AS subjects FROM p GROUP BY 1 HAVING count(*) > 1) SELECT value, subject, subjects FROM p JOIN s USING (value)""")
def q_shared_ids(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    cells = rows.select(F.col("o_custkey").alias("subject"), F.col("l_partkey").cast("string").alias("rack"), F.col("l_suppkey").cast("string").alias("position"))
    return subjects.shared_values(cells.withColumn("value", subjects.vial_key("rack", "position")), "subject", "value")


@query("""SELECT o_orderkey, 'o_orderstatus' AS variable, o_orderstatus AS before, 'X' AS after FROM orders WHERE o_orderkey % 7 = 0 UNION ALL
 SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR), CAST(o_custkey + 1 AS VARCHAR) FROM orders WHERE o_orderkey % 5 = 0""")
def q_snapshot_diff(spark, sf_dir):
    before = t(spark, sf_dir, "orders")
    price = F.concat(F.lit(" "), F.col("o_totalprice").cast("string"))  # the same number in another spelling
    after = before.withColumns({"o_orderstatus": F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")), "o_custkey": F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")), "o_totalprice": price})
    return diffs.changed_cells(before, after, ["o_orderkey"])


@query("""WITH a AS (SELECT DISTINCT p_name || ' ' || p_type AS variable FROM part WHERE p_size < 25), b AS (SELECT DISTINCT p_name || ' ' || p_type AS variable FROM part WHERE p_size >= 25)
 SELECT variable, 'removed' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT variable, 'added' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def q_column_diff(spark, sf_dir):
    names = t(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("variable"), "p_size")
    return diffs.column_changes(names.where("p_size < 25").select("variable").distinct(), names.where("p_size >= 25").select("variable").distinct())


@query("""WITH o AS (SELECT o_custkey AS subject, CAST(year(o_orderdate) AS INTEGER) AS visit, lower(trim(o_orderpriority)) AS form, count(*) AS old_count FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3),
 n AS (SELECT o_custkey AS subject, CAST(year(o_orderdate) AS INTEGER) AS visit, lower(trim(o_orderpriority)) AS form, count(*) AS new_count FROM orders WHERE o_totalprice > 100000 GROUP BY 1, 2, 3)
 SELECT subject, visit, replace(form, ' ', '_') AS form, old_count, new_count, CASE WHEN old_count IS NULL THEN 'new only' WHEN new_count IS NULL THEN 'old only' ELSE 'both' END AS side FROM o FULL JOIN n USING (subject, visit, form)""")
def q_tracker_compare(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject"), F.year("o_orderdate").alias("visit"), diffs.normal_form("o_orderpriority").alias("form"), "o_orderstatus", "o_totalprice")
    count = lambda df: df.groupBy("subject", "visit", "form").agg(F.count("*").alias("flag_count"))
    return diffs.compared_trackers(count(rows.where("o_orderstatus = 'F'")), count(rows.where("o_totalprice > 100000")), ["subject", "visit", "form"])


def day_flags(spark, sf_dir, day: str) -> DataFrame:
    errors = t(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", F.to_date("ts").alias("d"), F.col("event_type").alias("form")).where(F.col("d") == F.lit(day).cast("date"))
    none = F.array().cast("array<date>")
    return errors.distinct().select(F.col("user_id").alias("subject"), "form", F.array("d").alias("dates_detected"), none.alias("dates_resolved"), F.lit(False).alias("currently_resolved"), F.lit("").alias("manually_resolved"), F.lit("").alias("comments"), F.lit("").alias("site_comments"))


@query("""WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error'), o AS (SELECT user_id FROM e WHERE d = DATE '2024-01-10'), n AS (SELECT user_id FROM e WHERE d = DATE '2024-01-11')
 SELECT coalesce(o.user_id, n.user_id) AS subject, CASE WHEN o.user_id IS NULL THEN '2024-01-11' ELSE '2024-01-10' END AS detected, CASE WHEN n.user_id IS NULL THEN '2024-01-11' ELSE '' END AS resolved, n.user_id IS NULL AS currently_resolved,
 CAST(CASE WHEN o.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS age FROM o FULL JOIN n ON o.user_id = n.user_id""")
def q_lifecycle_step(spark, sf_dir):
    out = lifecycle.step(day_flags(spark, sf_dir, "2024-01-10"), day_flags(spark, sf_dir, "2024-01-11"), F.lit("2024-01-11"), keys=("subject", "form"))
    joined = lambda x: F.array_join(F.transform(x, lambda d: d.cast("string")), ",")
    return out.select("subject", joined("dates_detected").alias("detected"), joined("dates_resolved").alias("resolved"), "currently_resolved", F.col("time_since_last_detection").alias("age"))


@query("""WITH r AS (SELECT d, row_number() OVER (ORDER BY d) AS k FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)), p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error'),
 g AS (SELECT user_id, d, k, k - row_number() OVER (PARTITION BY user_id ORDER BY k) AS s FROM p JOIN r USING (d)), m AS (SELECT user_id, s, min(d) AS detected, max(k) AS last, count(*) AS runs FROM g GROUP BY 1, 2)
 SELECT user_id, detected, r.d AS resolved, runs FROM m LEFT JOIN r ON r.k = m.last + 1""")
def q_lifecycle_history(spark, sf_dir):
    days = t(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("d"))
    return lifecycle.history(days, days.where("event_type = 'error'"), "user_id", "d")


def order_flags(spark, sf_dir) -> DataFrame:
    """Two kinds of flags for each customer and year, in a fixed order."""
    rows = lines_with_orders(spark, sf_dir).withColumn("year", F.substring("ordered", 1, 4))
    checks = [rules.ordered("order", "ordered", "ship"), rules.outside("quantity", "l_quantity", None, 45)]
    found = rules.evaluate(rows, checks, ["o_custkey", "year", "l_orderkey"])
    return found.select("o_custkey", "year", (F.col("seq").cast("long") * 1_000_000_000_000 + F.col("l_orderkey")).alias("seq"), F.concat_ws(" ", "rule", F.col("l_orderkey").cast("string")).alias("error_message"))


ORDER_FLAGS = LINES + """, f AS (SELECT o_custkey, substr(ordered, 1, 4) AS year, l_orderkey AS seq, 'order ' || l_orderkey AS error_message FROM lines WHERE ordered > ship
 UNION ALL SELECT o_custkey, substr(ordered, 1, 4), 1000000000000 + l_orderkey, 'quantity ' || l_orderkey FROM lines WHERE l_quantity > 45), d AS (SELECT o_custkey, year, error_message, min(seq) AS seq FROM f GROUP BY 1, 2, 3) """


@query(ORDER_FLAGS + "SELECT o_custkey, year, string_agg(error_message, ' | ' ORDER BY seq) AS flags, count(*) AS flag_count FROM d GROUP BY 1, 2")
def q_tracker_merge(spark, sf_dir):
    return tracker.merged(order_flags(spark, sf_dir), keys=("o_custkey", "year"))


@query("""WITH f AS (SELECT DISTINCT user_id AS subject, 'day ' || CAST(day(ts) AS VARCHAR) AS error_message FROM events WHERE event_type = 'error'), s AS (SELECT conv_id AS subject, 'day ' || CAST(turn + 1 AS VARCHAR) AS error_message, min(role) AS comments FROM conversations GROUP BY 1, 2)
 SELECT f.subject, f.error_message, CASE WHEN f.subject IN (SELECT subject FROM s) THEN coalesce(s.comments, '') ELSE 'old' END AS comments FROM f LEFT JOIN s ON s.subject = f.subject AND s.error_message = f.error_message""")
def q_review_merge(spark, sf_dir):
    no = F.lit("")
    where = {"displayed_timepoint": F.lit("t"), "displayed_form": F.lit("f")}
    flags = t(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").alias("subject"), F.concat(F.lit("day "), F.day("ts").cast("string")).alias("error_message")).distinct()
    flags = flags.withColumns(where | {"manually_resolved": no, "comments": F.lit("old"), "site_comments": no})
    turns = t(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("subject"), F.col("role").alias("comments")).agg(piped(F.collect_set(F.concat(F.lit("day "), (F.col("turn") + 1).cast("string")))).alias("flags"))
    return lifecycle.reviewed(flags, turns.withColumns(where | {"manually_resolved": no, "site_comments": no})).select("subject", "error_message", "comments")


@query("""WITH o AS (SELECT r_name AS network, n_name AS site, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS age FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_orderstatus <> 'F')
 SELECT r_name AS network, n_name AS site, count(*) FILTER (age > 30) AS older, count(*) FILTER (age <= 30) AS newer FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN o ON site = n_name AND network = r_name GROUP BY 1, 2""")
def q_site_backlog(spark, sf_dir):
    place = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("site"), F.col("r_name").alias("network"))
    orders = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey"))
    flags = orders.select("network", "site", (F.col("o_orderstatus") == "F").alias("currently_resolved"), F.datediff(F.lit("1998-12-31").cast("date"), F.to_date("o_orderdate")).alias("time_since_last_detection"))
    return tracker.site_backlog(flags, place.select("network", "site"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'blue' WHEN o_orderstatus = 'F' THEN 'green' WHEN age < 7 THEN 'yellow' WHEN age < 14 THEN 'orange' ELSE 'red' END AS status_class,
 CAST(CASE WHEN o_orderkey % 11 = 0 THEN 2 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS bucket FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-31') AS age FROM orders)""")
def q_status_class(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("currently_resolved"), F.when(F.col("o_orderkey") % 11 == 0, "yes").otherwise("").alias("manually_resolved"), F.datediff(F.lit("1998-12-31").cast("date"), F.to_date("o_orderdate")).alias("days_since_detected"))
    return tracker.classed(rows).select("o_orderkey", "status_class", "bucket")


@query("""WITH f AS (SELECT o_orderkey, o_custkey AS subject, CASE WHEN o_orderstatus = 'F' THEN ['Main Report'] WHEN o_orderstatus = 'O' THEN ['Main Report', 'Incomplete Forms'] ELSE [] END AS reports FROM orders), x AS (SELECT o_orderkey, subject, unnest(reports) AS report FROM f),
 r AS (SELECT DISTINCT o_custkey AS subject, l_suppkey AS rater FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1) SELECT report, rater, count(*) AS flags FROM x JOIN r USING (subject) GROUP BY 1, 2""")
def q_report_fanout(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    main, more = F.lit("Main Report"), F.lit("Incomplete Forms")
    flags = orders.select("o_orderkey", F.col("o_custkey").alias("subject"), F.when(F.col("o_orderstatus") == "F", F.array(main)).when(F.col("o_orderstatus") == "O", F.array(main, more)).otherwise(F.array().cast("array<string>")).alias("reports"))
    raters = t(spark, sf_dir, "lineitem").where("l_linenumber = 1").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("subject"), F.col("l_suppkey").alias("rater")).distinct()
    return tracker.fanned_out(flags, raters).groupBy("report", "rater").agg(F.count("*").alias("flags"))


def words_dictionary(spark, sf_dir) -> DataFrame:
    """Documents as a data dictionary: the source is the form, the language the field type."""
    docs = t(spark, sf_dir, "documents")
    no = F.lit("")
    return docs.select(
        F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("variable"), F.col("source").alias("form"), F.col("lang").alias("field_type"), F.col("text").alias("label"), no.alias("choices"), no.alias("branching_logic"),
        F.when(F.col("n_chars") > 1000, "y").otherwise("").alias("required"), F.when(F.col("doc_id") % 9 == 0, "y").otherwise("").alias("identifier"),
    )


@query("""WITH d AS (SELECT 'v' || doc_id AS variable, source AS form, lang, text, n_chars, doc_id FROM documents), m AS (SELECT form, variable FROM d WHERE n_chars > 1000 AND doc_id % 9 <> 0 AND (contains(text, 'tion') OR contains(text, '.')) AND NOT regexp_matches(variable, '7'))
 SELECT form, count(*) AS n, md5(array_to_string(list_sort(list(variable)), ',')) AS variables FROM m GROUP BY 1""")
def q_dictionary_rules(spark, sf_dir):
    dictionary = words_dictionary(spark, sf_dir)
    listed = dd.blank_check_variables(dictionary, []).join(dictionary.where(dd.any_text("label", ["tion", "."])).select("variable"), "variable", "left_semi")
    excluded = dd.excluded_variables(dictionary, {"all": ["7"]}).select("variable")
    left = listed.join(excluded, "variable", "left_anti")
    return left.groupBy("form").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("variable")), ",")).alias("variables"))


@query("SELECT page_id, md5(translate(regexp_replace(html, '<.*?>', '', 'g'), chr(60) || chr(62) || '/' || chr(10), '')) AS label FROM pages")
def q_label_strip(spark, sf_dir):
    rows = t(spark, sf_dir, "pages").select(F.col("page_id").alias("variable"), F.col("html").alias("label"), F.lit("").alias("choices"))
    return dd.labels(rows).select(F.col("variable").alias("page_id"), F.md5("label").alias("label"))


@query("""WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS identifier FROM part UNION SELECT 'the' UNION SELECT 'of'), d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(replace(text, ' ', '] ['), '\\[([a-z]+)\\]', 1))) AS identifier FROM documents)
 SELECT identifier, count(*) AS documents FROM d WHERE identifier IN (SELECT identifier FROM w) GROUP BY 1""")
def q_identifier_refs(spark, sf_dir):
    words = t(spark, sf_dir, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("identifier")).distinct().unionByName(spark.createDataFrame([("the",), ("of",)], "identifier string"))
    docs = t(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(" "), F.lit("] [")).alias("text"))
    found = docs.select("doc_id", F.explode(F.filter(predicates.mentioned(F.col("text")), lambda x: x.rlike("^[a-z]+$"))).alias("identifier"))
    return found.join(words, "identifier", "left_semi").groupBy("identifier").agg(F.count("*").alias("documents"))


@query("""WITH last AS (SELECT o_custkey, max(year(o_orderdate)) AS y FROM orders GROUP BY 1), r AS (SELECT o_orderkey, o_custkey % 2 = 1 AS own, CASE o_custkey % 3 WHEN 0 THEN 'CHR' WHEN 1 THEN 'HC' ELSE 'unknown' END AS cohort, year(o_orderdate) AS y, last.y AS ly,
 CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS done, o_orderkey % 7 = 0 AS missing, o_totalprice, o_custkey % 5 = 0 AS excluded FROM orders JOIN last USING (o_custkey))
 SELECT o_orderkey, o_totalprice AS total, CAST(CASE WHEN excluded THEN 0 ELSE 1 END AS INTEGER) AS n_reports, y = 1992 AS priority_item FROM r
 WHERE o_totalprice > 150000 AND (cohort = 'CHR' OR (cohort = 'HC' AND y = 1992)) AND (done = 2 OR (own AND ly > y)) AND NOT missing AND NOT (own AND done = 3)""")
def q_gated_flags(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", (F.year("o_orderdate") - 1992).alias("ordinal"))
    dimension = model.timepoints(spark).select("timepoint", "ordinal")
    last = orders.groupBy("o_custkey").agg(F.max("ordinal").alias("ordinal")).join(F.broadcast(dimension), "ordinal").select("o_custkey", F.col("timepoint").alias("visit_status_string"))
    done = F.when(F.col("o_orderstatus") == "F", "2").when(F.col("o_orderstatus") == "P", "3.0").otherwise("0")
    cohort = F.when(F.col("o_custkey") % 3 == 0, "CHR").when(F.col("o_custkey") % 3 == 1, "HC").otherwise("unknown")
    rows = orders.join(F.broadcast(dimension), "ordinal").drop("ordinal").join(last, "o_custkey").select(
        "o_orderkey", F.concat(F.lit("AB"), F.col("o_custkey").cast("string")).alias("subjectid"), F.when(F.col("o_custkey") % 2 == 0, "PRONET").otherwise("PRESCIENT").alias("network"), cohort.alias("cohort"), "timepoint", "visit_status_string",
        done.alias("f_complete"), done.alias("f_complete_rpms"), F.when(F.col("o_orderkey") % 7 == 0, "1").otherwise("0").alias("f_missing"), F.col("o_totalprice").cast("string").alias("total"), F.lit("").alias("removed"),
        F.when(F.col("o_custkey") % 5 == 0, "excluded").otherwise("included").alias("inclusion_status"),
    )
    due = spark.createDataFrame([("CHR", x, ["f"]) for x in model.TIMEPOINTS] + [("HC", "screening", ["f"])], "cohort string, timepoint string, forms array<string>")
    ready, ok = gate.gated(gate.with_ordinals(rows, model.timepoints(spark)), [gate.Form("f", "f_complete", "f_missing")], due)
    found = rules.evaluate(ready, [rules.outside("total", "total", None, 150000, forms=("f",))], ["o_orderkey", "subjectid", "timepoint", "removed", "inclusion_status", "total"], ok)
    return flag_records(found, F.lit("1999-01-01")).select("o_orderkey", v.num("total").alias("total"), F.size("reports").alias("n_reports"), "priority_item")


@query(CELLS + """, w AS (SELECT variable, split_part(value, ' ', 1) AS value FROM long WHERE value NOT IN ('', '-9', '-3', '-99', '999', '1909-09-09'))
 SELECT variable, count(*) AS n, round(avg(CAST(try_cast(value AS DOUBLE) IS NOT NULL AS INTEGER)), 6) AS share FROM w GROUP BY 1 HAVING avg(CAST(try_cast(value AS DOUBLE) IS NOT NULL AS INTEGER)) > 0.3""")
def q_numeric_variables(spark, sf_dir):
    return discovery.mostly_numeric(long_cells(spark, sf_dir), share=0.3).withColumn("share", F.round("share", 6))


@query("""WITH s AS (SELECT l_linenumber AS k, avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem GROUP BY 1), z AS (SELECT l_suppkey, abs(l_quantity - m) / sd AS z, abs(l_discount - 0.05::DOUBLE) AS d FROM lineitem JOIN s ON k = l_linenumber WHERE sd > 0),
 r AS (SELECT l_suppkey, z, d, row_number() OVER (PARTITION BY l_suppkey ORDER BY z) AS a, row_number() OVER (PARTITION BY l_suppkey ORDER BY d) AS b FROM z),
 g AS (SELECT l_suppkey, count(*) AS n, sum(z) AS gt, sum(d) AS lt, sum(z) FILTER (a <= 5) AS gl, sum(d) FILTER (b <= 5) AS ll FROM r GROUP BY 1), o AS (SELECT s_suppkey AS l_suppkey, s_acctbal AS z FROM supplier WHERE s_acctbal > 0)
 SELECT l_suppkey, n, round(gt, 4) AS global_total, round(lt, 4) AS local_total, round(gl, 4) AS global_least, round(ll, 4) AS local_least, round(gt / z, 4) AS ratio FROM g JOIN o USING (l_suppkey) WHERE n > 5""")
def q_final_scores(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_discount", F.col("l_quantity").alias("value"))
    scored = discovery.z_scores(lines, ["l_linenumber"])
    pairs = scored.select("l_suppkey", F.col("z").alias("global_deviation"), F.abs(F.col("l_discount") - 0.05).alias("local_deviation"))
    outliers = t(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("z"))
    found = discovery.final_scores(pairs, outliers, ["l_suppkey"], above=None)  # its SQL sums all pairs
    return found.select("l_suppkey", "n", *[F.round(x, 4).alias(x) for x in ("global_total", "local_total", "global_least", "local_least", "ratio")])


@query("""SELECT 'v' || doc_id AS variable, 'pattern' AS reason FROM documents WHERE n_chars % 4 = 3 UNION ALL SELECT 'v' || doc_id, 'identifier' FROM documents WHERE n_chars % 4 IN (2, 3)""")
def q_predicate_coverage(spark, sf_dir):
    logic = F.when(F.col("n_chars") % 4 == 0, "").when(F.col("n_chars") % 4 == 1, "[a]='1'").when(F.col("n_chars") % 4 == 2, "[a(2)]<>'3' and [b]>4").otherwise("datediff([a],[b])>3")
    docs = t(spark, sf_dir, "documents").select(F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("variable"), logic.alias("branching_logic"), F.lit("").alias("choices"), F.lit("").alias("identifier"))
    return dd.unsupported(docs.unionByName(spark.createDataFrame([("b", "", "", "y")], "variable string, branching_logic string, choices string, identifier string")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range and date-order rules over lines, merged for each customer and year."""
    return q_tracker_merge(spark, sf_dir)

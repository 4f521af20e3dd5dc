"""The rule catalogue as queries: parts as form rows, each variable a cell whose text follows from the part's key, and the rules written out in SQL.

Cells are SQL that Spark and DuckDB read alike, so both sides see the same rows; what a rule says is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import predicates
from tallyward.functions.expressions import lit
from tallyward.operators import catalog, crosschecks, gate, rules
from tallyward.plans import content, model, run
from tallyward.plans.queries import query, t

# cells


def numbers(i: int, most: int, low: int = 0) -> str:
    """Mostly whole numbers from low; also blanks, a missing code, a word and another spelling."""
    x = f"((k * {2 * i + 3} + k // {i % 7 + 2}) % {most})"
    x = x.replace(f"k // {i % 7 + 2}", f"CAST(floor(k / {i % 7 + 2}) AS BIGINT)")
    return f"CASE (k + {i}) % 19 WHEN 0 THEN '' WHEN 1 THEN '-9' WHEN 2 THEN 'x' WHEN 3 THEN CAST({x} + {low} AS STRING) || '.0' ELSE CAST({x} + {low} AS STRING) END"


def days(i: int, start: str, span: int) -> str:
    """Mostly dates from a day on; also blanks, a missing date and a word."""
    return f"CASE (k + {i}) % 13 WHEN 0 THEN '' WHEN 1 THEN '1909-09-09' WHEN 2 THEN 'soon' ELSE CAST(DATE '{start}' + CAST((k * {2 * i + 5}) % {span} AS INT) AS STRING) END"


def one_of(i: int, *texts: str) -> str:
    return f"CASE CAST(floor(k / {i % 5 + 1}) AS BIGINT) % {len(texts)} " + " ".join(f"WHEN {n} THEN '{x}'" for n, x in enumerate(texts)) + " END"


def rows_of(spark, sf_dir, cells: dict[str, str]) -> DataFrame:
    """Parts' keys, few bytes in few row groups of a file, dealt to all cores, as each makes a wide row."""
    keys = t(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k")).repartition(2 * spark.sparkContext.defaultParallelism, "k")
    return keys.select("k", *[F.expr(x).alias(name) for name, x in cells.items()])


def with_cells(cells: dict[str, str]) -> str:
    return "WITH o AS (SELECT CAST(p_partkey AS BIGINT) AS k FROM part), c AS (SELECT k, " + ", ".join(f"{x} AS {name}" for name, x in cells.items()) + " FROM o) "


# conditions in SQL


def number(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def value(x: str) -> str:
    return f"CASE WHEN {number(x)} NOT IN (-3, -9, -99, 999) THEN {number(x)} END"


def among(x: str, *codes) -> str:
    return f"coalesce({number(x)} IN ({', '.join(map(str, codes))}), false)"


def blank_or_missing(x: str) -> str:
    return f"({x} = '' OR coalesce({number(x)} IN (-3, -9, -99, 999), false) OR {x} IN ('1909-09-09', '1903-03-03', '1901-01-01'))"


def day(x: str) -> str:
    return f"CASE WHEN {x} NOT IN ('1909-09-09', '1903-03-03', '1901-01-01') THEN try_cast({x} AS DATE) END"


def apart(a: str, b: str) -> str:
    return f"abs(date_diff('day', {a}, {b}))"


def fired(cells: dict[str, str], conditions: dict[str, str]) -> str:
    """(k, rule) of what holds."""
    cases = ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in conditions.items())
    return with_cells(cells) + f"SELECT k, rule FROM (SELECT k, unnest([{cases}]) AS rule FROM c) WHERE rule IS NOT NULL"


def all_rules(spark, sf_dir, cells: dict[str, str], made: list[rules.Rule]) -> DataFrame:
    return rules.evaluate(rows_of(spark, sf_dir, cells), made, ["k"]).select("k", "rule")


def generic(names: set[str], own: dict[str, str], most: int = 8) -> dict[str, str]:
    """Cells of some variables."""
    return {x: own.get(x, numbers(i, most)) for i, x in enumerate(sorted(names))} | {x: c for x, c in own.items() if x not in names}


# R9-R15

RUN_DATE = "2024-03-01"
BLOOD_CELLS = {
    "network": one_of(0, "PRONET", "PRESCIENT"), "vol": one_of(1, "0", "0.5", "1.1", "1.2", "", "-9", "x", "-1"), "bar": one_of(2, "123", "12345678ab", "1234567890", "pronet1", "", "-9", "12 4567890"),
    "chrblood_drawdate": "CASE k % 7 WHEN 0 THEN 'bad' WHEN 1 THEN '-9' ELSE CAST(DATE '2024-01-02' + CAST(k % 3 AS INT) AS STRING) || ' 1' || CAST(k % 10 AS STRING) || ':30' END",
    "chrblood_labdate": "CAST(DATE '2024-01-02' + CAST(k % 4 AS INT) AS STRING) || ' 1' || CAST((k * 3) % 10 AS STRING) || ':30'",
    "chrcbc_wbcsum": numbers(3, 40), "cbc_with_differential_complete": one_of(3, "0", "1", "2", "2.0", ""), "chrblood_cbc": one_of(1, "0", "1", "1.0", "", "-9"), "chrblood_interview_date": days(4, "2024-02-20", 30),
    **{x: numbers(i + 5, 40) for i, x in enumerate(sorted({*catalog.CBC_ABOVE, *catalog.CBC_BELOW}))}, **{x: numbers(i + 20, 900) for i, x in enumerate(catalog.FREEZE_TIMES)},
}


def blood_conditions() -> dict[str, str]:
    counted = f"NOT {blank_or_missing('bar')} AND position('pronet' IN lower(bar)) = 0"
    tenth = "CAST(0.1 AS DOUBLE)"
    total, part = value("chrcbc_wbc"), value("chrcbc_wbcsum")
    sent, done = among("chrblood_cbc", 1), among("cbc_with_differential_complete", 2)
    draw = "chrblood_drawdate LIKE '20%' AND chrblood_drawdate > chrblood_labdate"
    out = {"volume vol": f"{value('vol')} <= 0 OR {value('vol')} > CAST(1.1 AS DOUBLE)", "draw before lab": draw, "short bar": f"{counted} AND length(bar) < 10", "digits bar": f"{counted} AND NOT regexp_full_match(bar, '[0-9]+')"}
    out |= {f"freeze {x}": f"{value(x)} > 480" for x in catalog.FREEZE_TIMES}
    out["white cells"] = f"({part}) < ({total}) - {tenth} * ({total}) OR ({part}) > ({total}) + {tenth} * ({total})"
    for sign, limits in ((">", catalog.CBC_ABOVE), ("<", catalog.CBC_BELOW)):
        for x, limit in limits.items():
            hit = f"network <> 'PRESCIENT' AND ({value(x)}) {sign} CAST({limit} AS DOUBLE)"
            out[f"units {x}"] = f"({out[f'units {x}']}) OR ({hit})" if f"units {x}" in out else hit
    late = f"{apart(day('chrblood_interview_date'), f'DATE {chr(39)}{RUN_DATE}{chr(39)}')} > 5"
    return out | {"sent, not complete": f"NOT {done} AND {sent} AND {late}", "complete, not sent": f"{done} AND NOT {sent}"}


@query(fired(BLOOD_CELLS, blood_conditions()))
def q_catalog_blood(spark, sf_dir):
    made = catalog.blood_rules(("vol",), ("bar",), lit(RUN_DATE).cast("date"))
    return all_rules(spark, sf_dir, BLOOD_CELLS, made)


# R16-R25, R35-R38

CLINICAL_CELLS = {
    "age": one_of(2, "15", "20.5", "unknown", "31", "40"), "demographics_age": numbers(90, 40), "chrpps_fage": numbers(91, 99), "chrpps_mage": numbers(92, 99), "chrfigs_mother_age": numbers(93, 130), "chrfigs_father_age": numbers(94, 130),
    "chrpps_fdob": days(95, "1925-01-01", 33000), "chrpps_mdob": days(96, "1925-01-01", 33000), "chrpps_interview_date": days(97, "2022-01-01", 700), "chrchs_weightkg": numbers(98, 90, -20), "visit_status_string": one_of(3, "month1", "converted", "baseline"),
    **{x: numbers(100 + i, 45) for i, x in enumerate(catalog.ONSET_AGES)},
}


def clinical_names() -> set[str]:
    """The variables of `catalog.clinical_rules`."""
    out = {f"chroasis_oasis_{n}" for n in range(1, 6)} | {f"chrpps_{x}{y}" for x in "fm" for y in ("dob", "age")} | {"chrpps_interview_date", "demographics_age", "chrchs_weightkg", "chrbprs_bprs_unus"}
    for pairs in (catalog.CSSRS_YES, catalog.CSSRS_COUNTS):
        out |= {*pairs, *pairs.values()}
    out |= {"chrgfs_gf_social_scale", "chrgfr_gf_role_scole", *(f"{x}_{y}" for x in ("chrgfs_gf_social", "chrgfr_gf_role") for y in ("high", "low")), "chrtbi_subject_head_injury", "chrtbi_parent_headinjury", "chrtbi_sourceinfo"}
    out |= {f"chrbprs_bprs_{x}" for x in ("somc", "guil", "gran", "susp")} | {*catalog.CONVERTS_ABOVE, *catalog.CONVERTS_AT, *catalog.PARENT_AGES, *catalog.ONSET_AGES}
    return out | {"chrpas_pmod_adult3v1", "chrpas_pmod_adult3v3"}


def clinical_conditions() -> dict[str, str]:
    out = {f"anxiety {n}": f"{among('chroasis_oasis_1', 0)} AND {value(f'chroasis_oasis_{n}')} > 0" for n in range(2, 6)}
    out |= {f"lifestyle chroasis_oasis_{n}": f"({value('chroasis_oasis_3')}) < 2 AND ({value(f'chroasis_oasis_{n}')}) > {cut}" for n, cut in ((4, 1), (5, 0))}
    out |= {f"lifetime {life}": f"{among(life, 2)} AND {among(recent, 1)}" for life, recent in catalog.CSSRS_YES.items()}
    out |= {f"count {life}": f"({value(life)}) < ({value(recent)})" for life, recent in catalog.CSSRS_COUNTS.items()}
    for stem, scale in (("chrgfs_gf_social", "chrgfs_gf_social_scale"), ("chrgfr_gf_role", "chrgfr_gf_role_scole")):
        low, high = f"{stem}_low", f"{stem}_high"
        out[f"extreme {low}"] = f"({value(low)}) > least({value(scale)}, {value(high)})"
        out[f"extreme {high}"] = f"({value(high)}) < greatest({value(scale)}, {value(low)})"
    subject, parent, source = "chrtbi_subject_head_injury", "chrtbi_parent_headinjury", "chrtbi_sourceinfo"
    out["head injury"] = f"{among(source, 3)} AND ({value(subject)}) <> ({value(parent)})"
    out["informants"] = f"{among(source, 1, 2)} AND {among(subject, 0, 1)} AND {among(parent, 0, 1)}"
    for item, low in (("somc", "1, 2, 3"), ("guil", "1, 2, 3"), ("gran", "1, 2, 3"), ("susp", "1")):
        out[f"{item} and unusual"] = f"{among(f'chrbprs_bprs_{item}', 6, 7)} AND {among('chrbprs_bprs_unus', low)}"
    out["weight"] = f"{number('chrchs_weightkg')} < 0"
    for sign, limits in ((">", catalog.CONVERTS_ABOVE), ("=", catalog.CONVERTS_AT)):
        out |= {f"conversion {x}": f"{number(x)} {sign} {limit} AND visit_status_string <> 'converted'" for x, limit in limits.items()}
    out["marriage"] = f"{among('chrpas_pmod_adult3v1', 0, 1, 2, 3)} AND {among('chrpas_pmod_adult3v3', 0, 1, 2, 3, 4, 5, 6)}"
    for x in ("f", "m"):
        years = f"(date_diff('day', {day(f'chrpps_{x}dob')}, {day('chrpps_interview_date')}) / CAST(365 AS DOUBLE))"
        out[f"birth {x}"] = f"{years} < 10 OR {years} > 85"
        out[f"age {x}"] = f"{years} - ({value(f'chrpps_{x}age')}) >= 1"
        out[f"demographic age {x}"] = f"{years} - ({value('demographics_age')}) >= 1"
    for names, low, high in ((catalog.PARENT_AGES, 10, 85), (catalog.ONSET_AGES, 0, 0)):
        for x in names:
            between = f"round(abs({number('age')} - ({value(x)})), 2)"
            out[f"age difference {x}"] = f"{between} < {low} OR {between} > {high}"
    return out


@query(fired(generic(clinical_names(), CLINICAL_CELLS), clinical_conditions()))
def q_catalog_clinical(spark, sf_dir):
    return all_rules(spark, sf_dir, generic(clinical_names(), CLINICAL_CELLS), catalog.clinical_rules())


# R27, R28, R30-R34

NAMES = ("573", "888", "542.0", "", "12", "-9", "888.0", "12")
MEDICATION_CELLS = {
    **{f"chrpharm_med{n}_name{p}": one_of(n + 2 * bool(p), *NAMES[n:], *NAMES[:n]) for n in (1, 2, 3) for p in ("", "_past")},
    **{f"chrpharm_med{n}_onset{p}": days(n + 7 * bool(p), "2023-01-01", 60) for n in (1, 2, 3) for p in ("", "_past")},
    **{f"chrpharm_med{n}_offset{p}": days(n + 11 * bool(p), "2023-01-15", 60) for n in (1, 2) for p in ("", "_past")},
    **{f"chrpharm_lastuse_med{n}": days(n + 20, "2023-02-01", 60) for n in (1, 2, 3)}, **{f"chrpharm_med{n}_use": one_of(n, "1", "2", "", "2.0") for n in (1, 2, 3)},
    "chrpharm_med2_dosage": one_of(3, "", "5", "-9"), "chrpharm_med1_mo1": one_of(4, "", "", "1"), "chrpharm_interm_meds": one_of(1, "", "", "", "y"), "chrpharm_firstdose_med1": days(1, "2023-01-01", 60), "chrpharm_date_mod": days(31, "2023-01-20", 60),
}


def medication_conditions() -> dict[str, str]:
    on, dose = "chrpharm_med1_onset", "chrpharm_firstdose_med1"
    out = {"first dose": f"NOT {blank_or_missing(on)} AND NOT {blank_or_missing(dose)} AND {on} <> {dose}"}
    for p in ("", "_past"):
        out |= {f"onset {n}{p}": f"{day(f'chrpharm_med{n}_onset{p}')} > {day(f'chrpharm_med{n}_offset{p}')}" for n in (1, 2)}
        out |= {f"medication {n}{p}": among(f"chrpharm_med{n}_name{p}", 573, 542, 538, 539) for n in (1, 2, 3)}
    latest = f"greatest({', '.join(day(f'chrpharm_med{n}_onset') for n in (1, 2, 3))})"
    out["latest onset"] = f"{apart(latest, day('chrpharm_date_mod'))} > 10"
    return out


@query(fired(MEDICATION_CELLS, medication_conditions()))
def q_catalog_medication(spark, sf_dir):
    names = list(MEDICATION_CELLS)
    return all_rules(spark, sf_dir, MEDICATION_CELLS, catalog.medication_rules(names) + catalog.latest_onset(names))


def unknown_sql() -> str:
    parts = []
    for p, title in (("", "unknown medication"), ("_past", "unknown past medication")):
        fields = {n: [x for f in catalog.SLOT_FIELDS if (x := f"chrpharm_{f.format(n=n)}{p}") in MEDICATION_CELLS] for n in (1, 2, 3)}
        unknown = {n: among(f"chrpharm_med{n}_name{p}", 888) for n in fields}
        names = ", ".join(f"CASE WHEN {unknown[n]} AND ({' OR '.join(f'NOT {blank_or_missing(x)}' for x in fields[n])}) THEN 'chrpharm_med{n}_name{p}' END" for n in fields)
        others, seen = [], {}
        for n, xs in fields.items():
            for x in xs:  # a field that several slots share counts once, at its first place
                others.append(f"CASE WHEN {unknown[n]} AND NOT {blank_or_missing(x)}{''.join(f' AND NOT {unknown[m]}' for m in seen.get(x, []))} THEN '{x}' END")
                seen.setdefault(x, []).append(n)
        parts.append(f"SELECT k, '{title}' AS rule, [x for x in [{names}] if x IS NOT NULL] AS names, [x for x in [{', '.join(others)}] if x IS NOT NULL] AS others FROM c")
    return with_cells(MEDICATION_CELLS) + f"SELECT k, rule, array_to_string(list_concat(names, others), ',') AS variables FROM ({' UNION ALL '.join(parts)}) WHERE len(names) > 0"


@query(unknown_sql())
def q_unknown_medication(spark, sf_dir):
    found = rules.evaluate(rows_of(spark, sf_dir, MEDICATION_CELLS), catalog.unknown_names(list(MEDICATION_CELLS)), ["k"])
    return found.select("k", "rule", F.array_join("variables", ",").alias("variables"))


def overlap_sql() -> str:
    slots = " UNION ALL ".join(f"SELECT k, {n} AS slot, chrpharm_med{n}_name AS name, {day(f'chrpharm_med{n}_onset')} AS a, {day(f'chrpharm_lastuse_med{n}')} AS b, {number(f'chrpharm_med{n}_use')} AS u FROM c WHERE NOT {blank_or_missing(f'chrpharm_med{n}_name')}" for n in (1, 2, 3))
    return with_cells(MEDICATION_CELLS) + f""", s AS ({slots}) SELECT x.k, x.name, CAST(x.slot AS INTEGER) AS slot_1, CAST(y.slot AS INTEGER) AS slot_2 FROM s x JOIN s y ON x.k = y.k AND x.name = y.name AND x.slot < y.slot
 WHERE x.a <= y.b AND y.a <= x.b AND NOT coalesce((x.u = 1 AND y.u = 2) OR (x.u = 2 AND y.u = 1), false)"""


@query(overlap_sql())
def q_medication_overlap(spark, sf_dir):
    return catalog.overlapping_medications(rows_of(spark, sf_dir, MEDICATION_CELLS), ["k"])


# R39-R50

DIAGNOSES = {"chrscid_dx": {"criteria": ["chrscid_q1", "chrscid_q2"], "disorder": "Some", "extra": ["chrscid_q3 = '1'"], "variables": ["chrscid_q3"]}}
SCID_CELLS = {"chrscid_a48_1": numbers(3, 4), "chrscid_a26_53": numbers(5, 4), "chrscid_a22": numbers(7, 9), "chrscid_a22_1": numbers(8, 4), "chrscid_q3": one_of(1, "1", "0")}


SCID_NAMES = {f"chrscid_{x}" for x in "dx q1 q2 q3 a1 a2 a22 a22_1 a25 a26_53 a27 a28 a48_1 a51 a54 a70 a91 a92 a108 a129 a132 a138 a153 a170 c26 d1 d2 d3 d5 d9 d11 d23 d26 d27 d28".split()}


def scid_conditions() -> dict[str, str]:
    three = lambda x: among(f"chrscid_{x}", 3)
    either = lambda *x: "(" + " OR ".join(map(three, x)) + ")"
    met = f"({three('q1')} AND {three('q2')} AND chrscid_q3 = '1')"
    out = {"diagnosis chrscid_dx": f"{met} AND NOT {three('dx')}", "no diagnosis chrscid_dx": f"NOT {met} AND {three('dx')}"}
    ones = " AND ".join(among(f"chrscid_{x}", 1) for x in ("a54", "a92", "a132"))
    out["depressive manic"] = f"{ones} AND {three('d26')} AND {three('d27')} AND NOT {three('d28')}"
    for kind, a, b, d, more in (("major depressive", "a25", "a51", "d26", f" AND NOT {either('d3', 'd9', 'd11', 'd23')}"), ("manic", "a70", "a108", "d2", ""), ("hypomanic", "a91", "a129", "d5", "")):
        out[f"{kind} episode"] = f"(NOT {either(a, b)} AND {three(d)}) OR ({either(a, b)}{more} AND NOT {three(d)})"
    out["mania not fulfilled"] = f"NOT {either('a70', 'a91', 'a108', 'a129', 'a138')} AND NOT {three('d28')}"
    a, b = three("a27"), three("a28")
    counted = lambda n: among("chrscid_a48_1", n)
    out["depressed mood"] = f"({a} AND {b} AND NOT {counted(2)}) OR ({a} AND {among('chrscid_a28', 1, 2)}) OR ({b} AND {among('chrscid_a27', 1, 2)} AND NOT {counted(1)})"
    n = value("chrscid_a26_53")
    out["episode count"] = f"(({n}) < 1 AND {either('a25', 'a51')}) OR (({n}) > 0 AND NOT {either('a25', 'a51')})"
    out["threshold"] = f"NOT {either('a1', 'a2')} AND {three('a25')}"
    out["past threshold"] = f"NOT {either('a27', 'a28')} AND {three('a51')}"
    out["mood symptoms"] = f"{either('a25', 'a51', 'a70', 'a91', 'a108', 'a129', 'a138', 'a153', 'a170')} AND NOT {three('c26')} AND NOT {among('chrscid_d1', 1)}"
    out["mood episode"] = f"({value('chrscid_a22')}) > 4 AND ({value('chrscid_a22_1')}) > 0 AND {blank_or_missing('chrscid_a25')}"
    return out


@query(fired(generic(SCID_NAMES, SCID_CELLS, 4), scid_conditions()))
def q_catalog_scid(spark, sf_dir):
    # R45 counts one main criterion with its fellow below as wrong whatever the counter of the first says
    return all_rules(spark, sf_dir, generic(SCID_NAMES, SCID_CELLS, 4), catalog.scid_rules(DIAGNOSES))


# R5, R7, R8, R26

FORM_DATES = {"oasis": "oasis_date", "bprs": "bprs_date", "psychs_p1p8_fu": "fu_date"}
GENERAL_CELLS = {
    "chrguid_guid": one_of(0, "NDAAR1", "nda1", "", "NDA", "NDA-1"), "chrguid_pseudoguid": one_of(1, "NDAX", "", "X", "-9"), "age": one_of(2, "unknown", "11.9", "12", "30", "30.5", ""), "flag": one_of(3, "0", "1", "", "1.0"), "reason": one_of(4, "", "M6", "M1"),
    "psychs_screen_date": days(1, "2023-01-01", 30), **{x: days(i + 3, "2023-01-10", 40) for i, x in enumerate(FORM_DATES.values())},
}


def general_conditions() -> dict[str, str]:
    out = {f"identifier {x}": f"{x} <> '' AND NOT regexp_full_match({x}, 'NDA[A-Z0-9]+')" for x in ("chrguid_guid", "chrguid_pseudoguid")}
    out["age"] = f"age = 'unknown' OR {number('age')} < 12 OR {number('age')} > 30"
    out["reason f"] = f"{among('flag', 1)} AND reason = ''"
    # psychs_p1p8_fu is exempt
    return out | {f"21 days {f}": f"reason = 'M6' AND {apart(day(x), day('psychs_screen_date'))} > 21" for f, x in FORM_DATES.items() if f != "psychs_p1p8_fu"}


@query(fired(GENERAL_CELLS, general_conditions()))
def q_catalog_general(spark, sf_dir):
    made = [*catalog.general_rules(), catalog.missing_reason("flag", "reason", "f"), *catalog.within_21_days(FORM_DATES, "reason")]
    return all_rules(spark, sf_dir, GENERAL_CELLS, made)


# R51-R54

CROSS_CELLS = {
    "subjectid": "CAST(k AS STRING)", "timepoint": one_of(1, "screening", "baseline"), "chrconv_interview_date": days(2, "2023-01-01", 50), "chrpps_mage_baseline": numbers(1, 6, 40), "chrfigs_mother_age_screening": numbers(2, 6, 40),
    "chrpps_fage_baseline": numbers(3, 6, 40), "chrfigs_father_age_screening": numbers(4, 6, 40), "age": one_of(3, "20", "unknown", "15.5"), "demographics_date": days(5, "2023-01-01", 50), "chriq_interview_date": days(6, "2023-06-01", 50), "chriq_assessment": numbers(7, 4),
}
CROSS_SQL = f"""{with_cells(CROSS_CELLS)}, conv AS (SELECT CAST(o_custkey AS VARCHAR) AS subject FROM orders WHERE o_orderstatus = 'F'),
 legacy AS (SELECT CAST(o_custkey AS VARCHAR) AS subject, CASE WHEN o_orderkey % 2 = 0 THEN 'screening' ELSE 'baseline' END AS timepoint, CASE WHEN o_orderkey % 3 = 0 THEN 'IQ Assessment Wasii' ELSE 'Other' END AS general_flag,
 'Conversion of ' || o_orderpriority || ' | Scoring | no Conversion' AS specific_flags FROM orders)
 SELECT k, 'conversion date' AS kind, 'Subject converted, but date not filled out in conversion form.' AS text FROM c WHERE {blank_or_missing('chrconv_interview_date')} AND subjectid IN (SELECT subject FROM conv)
 UNION ALL SELECT k, 'ages', 'ages chrpps_mage_baseline' FROM c WHERE ({value('chrpps_mage_baseline')}) <> ({value('chrfigs_mother_age_screening')})
 UNION ALL SELECT k, 'ages', 'ages chrpps_fage_baseline' FROM c WHERE ({value('chrpps_fage_baseline')}) <> ({value('chrfigs_father_age_screening')})
 UNION ALL SELECT k, 'carried', trim(m) FROM (SELECT c.k, unnest(string_split(specific_flags, '|')) AS m FROM c JOIN legacy ON subject = subjectid AND legacy.timepoint = c.timepoint WHERE position('IQ Assessment Wasii' IN general_flag) > 0) WHERE position('Conversion' IN m) > 0
 UNION ALL SELECT k, 'age at test', CAST(CAST(round(({number('age')} + {apart(day('demographics_date'), day('chriq_interview_date'))} / CAST(365 AS DOUBLE)) * 1000) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST({number('chriq_assessment')} AS INTEGER) AS VARCHAR)
 FROM c WHERE {number('age')} IS NOT NULL AND {day('demographics_date')} IS NOT NULL AND {day('chriq_interview_date')} IS NOT NULL AND {among('chriq_assessment', 1, 2)}"""


@query(CROSS_SQL)
def q_crosschecks(spark, sf_dir):
    rows, orders = rows_of(spark, sf_dir, CROSS_CELLS), t(spark, sf_dir, "orders")
    subject = F.col("o_custkey").cast("string").alias("subject")
    conversions = orders.select(subject, F.when(F.col("o_orderstatus") == "F", "2024-01-01").alias("conversion_date"))
    legacy = orders.select(
        subject, F.when(F.col("o_orderkey") % 2 == 0, "screen").otherwise("baseln").alias("timepoint"), F.when(F.col("o_orderkey") % 3 == 0, "IQ Assessment Wasii").otherwise("Other").alias("general_flag"),
        F.concat(F.lit("Conversion of "), "o_orderpriority", F.lit(" | Scoring | no Conversion")).alias("specific_flags"),
    )
    conv = crosschecks.unrecorded_conversions(rows, conversions).select("k", F.lit("conversion date").alias("kind"), F.col("error_message").alias("text"))
    ages = rules.evaluate(rows, crosschecks.differing_ages(), ["k"]).select("k", F.lit("ages").alias("kind"), F.col("rule").alias("text"))
    carried = crosschecks.carried_flags(rows, legacy).select("k", F.lit("carried").alias("kind"), F.col("error_message").alias("text"))
    tested = rows.select("k", F.round(crosschecks.age_at_test() * 1000).cast("long").alias("a"), crosschecks.assessment().alias("b")).where("a is not null and b is not null")
    tested = tested.select("k", F.lit("age at test").alias("kind"), F.concat_ws(" ", F.col("a").cast("string"), F.col("b").cast("string")).alias("text"))
    return conv.unionByName(ages).unionByName(carried).unionByName(tested)


# Forms of predicates

PREDICATES = {
    "v_eq": ("[a]='1'", among("a", 1)), "v_plain": ("[a] = 2", among("a", 2)), "v_ne": ("[a]<>'1'", f"coalesce({number('a')} <> 1, true)"), "v_lt": ("[a]<'3'", f"coalesce({number('a')} < 3, false)"),
    "v_ge": ("[b] >= 4", f"coalesce({number('b')} >= 4, false)"), "v_blank": ("[d]=''", "d = ''"), "v_filled": ("[d]<>''", "d <> ''"), "v_zeros": ("[e]='00'", "e = '00'"), "v_box": ("[x(1)]='1'", among("x___1", 1)),
    "v_and": ("[a]='1' and [b]>'2'", f"{among('a', 1)} AND coalesce({number('b')} > 2, false)"), "v_or": ('([a]="1" or [b]="2") and [d]<>""', f"({among('a', 1)} OR {among('b', 2)}) AND d <> ''"),
    "v_two": ("[a]=[b]", f"coalesce({number('a')} = {number('b')} OR a = b, false)"), "v_absent": ("[nowhere]='1'", "false"), "v_absent_blank": ("[nowhere]=''", "true"), "v_none": ("", "true"),
    "chrtbi_age_first_inj": ("[a]='9'", f"{among('chrtbi_parent_headinjury', 1)} OR {among('chrtbi_subject_head_injury', 1)}"), "chrtbi_parent_headinjury": ("", among("chrtbi_sourceinfo", 2, 3)),
    "chrpharm_med2_onset_past": ("", f"coalesce({number('chrpharm_med2_name_past')} <> 999, true) AND {among('chrpharm_med1_add_past', 1)}"), "chrpsychs_av_audio_expl": ("[a]='9'", among("chrpsychs_av_audio_yn", 0)),
    "chrscid_b46": ("[a]='1'", f"{among('a', 1)} AND ({among('chrscid_b2', 3)} OR ({among('chrscid_b40', 3)} AND {among('chrscid_b41', 3)}))"), "chriq_pic_completion_raw": ("", among("chriq_assessment", 4, 5)),
}
PREDICATE_CELLS = {
    "a": one_of(0, "1", "2", "1.0", "", "-9", "x", "3"), "b": one_of(1, "1", "2", "4", "", "5"), "d": one_of(2, "", "w"), "e": one_of(3, "00", "0", ""), "x___1": one_of(4, "0", "1"), "chrtbi_parent_headinjury": one_of(1, "0", "1"),
    "chrtbi_subject_head_injury": one_of(2, "0", "1", ""), "chrtbi_sourceinfo": one_of(3, "1", "2", "3"), "chrpharm_med2_name_past": one_of(1, "999", "5", ""), "chrpharm_med1_add_past": one_of(2, "0", "1"), "chrpsychs_av_audio_yn": one_of(3, "0", "1"),
    "chrscid_b2": one_of(1, "1", "3"), "chrscid_b40": one_of(2, "1", "3"), "chrscid_b41": one_of(3, "1", "3"), "chriq_assessment": one_of(4, "4", "5", "1", ""),
}


@query(fired(PREDICATE_CELLS, {x: sql for x, (_, sql) in PREDICATES.items()}).replace("AS rule", "AS variable").replace("k, rule", "k, variable").replace("rule IS", "variable IS"))
def q_predicate_forms(spark, sf_dir):
    rows = rows_of(spark, sf_dir, PREDICATE_CELLS)
    listed = spark.createDataFrame([(x, text) for x, (text, _) in PREDICATES.items()], "variable string, branching_logic string")
    found = {r["variable"]: r["predicate"] for r in predicates.compiled(listed).where("rest = ''").collect()}
    cases = [F.when(F.expr(predicates.applicable(sql, rows.columns).text), x) for x, sql in found.items()]
    return rows.select("k", F.explode(F.filter(F.array(*cases), lambda x: x.isNotNull())).alias("variable"))


# the long path with gate, applicability, exclusions and modules; a whole run

DICTIONARY = [
    # variable, form, field type, label, branching logic, required, low, high
    ("chrblood_vol1", content.BLOOD, "text", "Volume", "", "y", "", ""), ("chrblood_bc1", content.BLOOD, "text", "barcode", "", "", "", ""), ("chrap_x", content.EXPOSURE, "text", "Exposure", "", "", "", ""),
    ("chroasis_oasis_1", "oasis", "text", "One", "", "y", "", ""), ("chroasis_oasis_2", "oasis", "text", "Two", "[chroasis_oasis_1]='1'", "y", "0", "3"), ("chrscid_b1", content.SCID, "text", "B1", "", "", "", ""),
    ("chrscid_b16", content.SCID, "text", "B16", "", "", "", ""), ("chrscid_c10", content.SCID, "text", "C10", "[chrap_x]<>'1'", "", "", ""), ("chrdemo_comment", "oasis", "text", "Comment", "", "y", "", ""), ("chrspeech_upload", "speech", "radio", "Upload", "", "", "", ""),
]
STUDY_FORMS = (content.BLOOD, content.EXPOSURE, "oasis", content.SCID, "speech")
VISITS = model.TIMEPOINTS
RUN_CELLS = {
    "chrblood_vol1": one_of(0, "1", "1.5", "", "-9", "0"), "chrblood_bc1": one_of(1, "1234567890", "123", ""), "chrap_x": one_of(2, "1", "-9", "", "2"), "chroasis_oasis_1": one_of(3, "0", "1", ""), "chroasis_oasis_2": one_of(4, "", "2", "7", "-9"),
    "chrscid_b1": one_of(1, "3", "", "1", "-9"), "chrscid_b16": one_of(0, "1", "3", ""), "chrscid_c10": one_of(2, "", "3", "1"), "chrdemo_comment": one_of(1, "", "y"), "chrspeech_upload": one_of(3, "0", "1", "0.0"),
    **{f"{f}_complete": one_of(i, "2", "2", "0", "2.0") for i, f in enumerate(STUDY_FORMS)}, **{f"{f}_complete_rpms": one_of(i + 1, "2", "3", "2") for i, f in enumerate(STUDY_FORMS)},
}


def study_of(spark, more: tuple = ()) -> run.Study:
    made = [(x, f, kind, label, "", logic, required, "", "", low, high) for x, f, kind, label, logic, required, low, high in (*DICTIONARY, *more)]
    names = ("variable", "form", "field_type", "label", "choices", "branching_logic", "required", "identifier", "validation", "validation_min", "validation_max")
    return run.study(spark.createDataFrame(made, ", ".join(f"{x} string" for x in names)))


def snapshot(spark, sf_dir) -> DataFrame:
    """One row for each customer and year of orders: its first order's key gives the cells."""
    orders = t(spark, sf_dir, "orders").groupBy("o_custkey", (F.year("o_orderdate") - 1992).alias("n")).agg(F.min("o_orderkey").alias("k"))
    last = orders.groupBy("o_custkey").agg(F.max("n").alias("last"))
    name = lambda x: F.get(F.array(*map(F.lit, VISITS)), F.col(x))
    rows = orders.join(last, "o_custkey").withColumns({"subjectid": F.col("o_custkey").cast("string"), "timepoint": name("n"), "visit_status_string": F.when(F.col("o_custkey") % 11 == 0, "removed").otherwise(name("last"))})
    rows = rows.withColumn("network", F.when(F.col("o_custkey") % 3 == 0, "PRESCIENT").otherwise("PRONET")).withColumn("k", F.col("k").cast("long"))
    return rows.select("subjectid", "network", "timepoint", "visit_status_string", "k", *[F.expr(x).alias(c) for c, x in RUN_CELLS.items()])


def people(spark, sf_dir) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("subject"), F.when(F.col("c_custkey") % 7 == 0, "excluded").otherwise("included").alias("inclusion_status"), F.when(F.col("c_custkey") % 5 == 0, "HC").otherwise("CHR").alias("cohort"), F.lit("20").alias("age"),
    )


def due_forms(spark) -> DataFrame:
    """HC have no SCID form and nobody a speech form at screening."""
    rows = [(c, x, [f for f in STUDY_FORMS if not (c == "HC" and f == content.SCID) and not (x == "screening" and f == "speech")]) for c in ("HC", "CHR") for x in VISITS]
    return spark.createDataFrame(rows, "cohort string, timepoint string, forms array<string>")


def gate_sql() -> str:
    names = "[" + ", ".join(f"'{x}'" for x in VISITS) + "]"
    own = "network = 'PRESCIENT'"
    ok = {}
    shown = {f: [x for x, form, *_, logic, _, _, _ in [(d[0], d[1], d[4], d[5], d[6], d[7]) for d in DICTIONARY] if form == f and logic == ""] for f in STUDY_FORMS}
    for f in STUDY_FORMS:
        count = " + ".join(f"CAST({x} <> '' AS INT)" for x in shown[f])
        sparse = f"({count}) < {len(shown[f])} / 2.0" if shown[f] else "false"
        complete = f"(CASE WHEN {own} THEN {among(f'{f}_complete_rpms', 2)} ELSE {among(f'{f}_complete', 2)} END OR ({own} AND moved))"
        due = {content.SCID: "cohort <> 'HC'", "speech": "timepoint <> 'screening'"}.get(f, "true")
        ok[f] = f"({complete} AND NOT (({own} AND {among(f'{f}_complete_rpms', 3, 4)}) OR {sparse}) AND {due})"
    passes = ", ".join(f"{x} AS ok{i}" for i, x in enumerate(ok.values()))
    cells = ", ".join(f"{x} AS {c}" for c, x in RUN_CELLS.items())
    return f"""WITH v AS (SELECT o_custkey, year(o_orderdate) - 1992 AS n, min(o_orderkey) AS k FROM orders GROUP BY 1, 2), w AS (SELECT *, max(n) OVER (PARTITION BY o_custkey) AS last FROM v),
 r AS (SELECT CAST(o_custkey AS VARCHAR) AS subjectid, {names}[CAST(n AS INTEGER) + 1] AS timepoint, CASE WHEN o_custkey % 3 = 0 THEN 'PRESCIENT' ELSE 'PRONET' END AS network, o_custkey % 11 = 0 AS removed, o_custkey % 11 <> 0 AND last > n AS moved,
 CASE WHEN o_custkey % 7 = 0 THEN 'excluded' ELSE 'included' END AS inclusion_status, CASE WHEN o_custkey % 5 = 0 THEN 'HC' ELSE 'CHR' END AS cohort, k FROM w),
 c AS (SELECT *, {cells} FROM r), g AS (SELECT *, {passes}, {own} AND ({blank_or_missing('chrscid_b1')} OR {blank_or_missing('chrscid_b16')}) AS skip FROM c), """


def of_form(f: str) -> str:
    return f"ok{STUDY_FORMS.index(f)}"


LOGIC = {"chroasis_oasis_2": among("chroasis_oasis_1", 1), "chrscid_c10": f"coalesce({number('chrap_x')} <> 1, true)"}


def long_sql() -> str:
    """Cells with their form that may be judged: for each variable of the dictionary but excluded ones."""
    parts = []
    for x, f, *_ in DICTIONARY:
        if "comment" not in x:
            tests = [of_form(f)] + ([f"({LOGIC[x]})"] if x in LOGIC else []) + (["NOT skip"] if "chrscid_" in x else [])
            parts.append(f"SELECT subjectid, timepoint, network, removed, inclusion_status, '{x}' AS variable, '{f}' AS form, {x} AS value FROM g WHERE {' AND '.join(tests)}")
    return " UNION ALL ".join(parts)


@query(gate_sql() + f"l AS ({long_sql()}) SELECT subjectid, timepoint, variable, value FROM l")
def q_eligible_cells(spark, sf_dir):
    of = study_of(spark)
    rows = run.with_subjects(snapshot(spark, sf_dir), people(spark, sf_dir), model.timepoints(spark))
    passing, passes = gate.gated(rows, of.forms, due_forms(spark))
    excluded = frozenset.union(*of.excluded.values())
    return rules.eligible_cells(passing, ["subjectid", "timepoint"], of.form_of, passes, content.applies(of.compiled, rows.columns), excluded, content.skipped(of.groups))


def run_sql() -> str:
    teams = {content.BLOOD: "Blood Report,Fluids Report", content.SCID: "Non Team Forms,Scid Report"}
    more = "CASE form " + " ".join(f"WHEN '{f}' THEN '{x}'" for f, x in teams.items()) + " ELSE 'Non Team Forms' END"
    keys = "subjectid, timepoint, removed, inclusion_status"
    judged = "NOT (form = 'speech')"
    # R1, R2 on judged cells; R1 also takes all SCID and exposure variables and those required
    blank = f"SELECT {keys}, variable, form, variable || ' : Variable is blank.' AS message, (CASE WHEN form = 'oasis' THEN 'Secondary Report' ELSE 'Main Report' END) || ',' || {more} AS reports FROM l WHERE value = '' AND {judged} AND variable <> 'chrblood_bc1'"
    code = f"SELECT {keys}, variable, form, variable || ' : Variable is a missing code (value = ' || value || ').', 'Main Report,' || {more} FROM l WHERE value = '-9' AND (form = '{content.EXPOSURE}' OR (network = 'PRESCIENT' AND form = '{content.SCID}'))"
    speech = f"SELECT {keys}, 'chrspeech_upload', 'speech', 'chrspeech_upload : Speech sample not uploaded to Box (value = ' || chrspeech_upload || ')', 'Secondary Report' FROM g WHERE {of_form('speech')} AND {among('chrspeech_upload', 0)}"
    outside = f"SELECT {keys}, 'chroasis_oasis_2', 'oasis', 'chroasis_oasis_2 : chroasis_oasis_2 is out of range (value = ' || chroasis_oasis_2 || ')', 'Main Report' FROM g WHERE {of_form('oasis')} AND ({value('chroasis_oasis_2')}) > 3"
    blood = "'Main Report,Blood Report,Fluids Report'"
    low = f"({value('chrblood_vol1')}) <= 0"
    volume = f"SELECT {keys}, 'chrblood_vol1', '{content.BLOOD}', 'chrblood_vol1 : Volume (chrblood_vol1 = ' || chrblood_vol1 || CASE WHEN {low} THEN ') is less than or equal to 0' ELSE ') is greater than 1.1' END, {blood} FROM g WHERE {of_form(content.BLOOD)} AND ({low} OR ({value('chrblood_vol1')}) > CAST(1.1 AS DOUBLE))"
    short = f"SELECT {keys}, 'chrblood_bc1', '{content.BLOOD}', 'chrblood_bc1 : Barcode (' || chrblood_bc1 || ') length is less than 10 characters.', {blood} FROM g WHERE chrblood_bc1 = '123'"
    anxiety = f"SELECT {keys}, 'chroasis_oasis_1', 'oasis', 'chroasis_oasis_1 : Marked as having no anxiety in chroasis_oasis_1, but chroasis_oasis_2 is equal to ' || chroasis_oasis_2, 'Secondary Report' FROM g WHERE {of_form('oasis')} AND {among('chroasis_oasis_1', 0)} AND ({value('chroasis_oasis_2')}) > 0"
    converts = f"SELECT {keys}, 'chrscid_c10', '{content.SCID}', 'chrscid_c10 : chrscid_c10 is ' || chrscid_c10 || ', but participant is not marked as converted.', 'Conversion Report' FROM g WHERE {of_form(content.SCID)} AND {among('chrscid_c10', 3)}"
    due = {content.SCID: "cohort <> 'HC'", "speech": "timepoint <> 'screening'"}
    compl = []
    for f in STUDY_FORMS:
        own = f"CASE WHEN network = 'PRESCIENT' THEN {f}_complete_rpms ELSE {f}_complete END"
        name = f"CASE WHEN network = 'PRESCIENT' THEN '{f}_complete_rpms' ELSE '{f}_complete' END"
        reports = "CASE WHEN network = 'PRESCIENT' THEN 'Main Report,Incomplete Forms' ELSE 'Incomplete Forms' END"
        compl.append(f"SELECT {keys}, {name}, '{f}', {name} || ' : Form is not marked as complete, but the subject has moved on.', {reports} FROM g WHERE moved AND {due.get(f, 'true')} AND NOT {among(own, 2, 3, 4)}")
    found = " UNION ALL ".join([blank, code, speech, outside, volume, short, anxiety, converts, *compl])
    return gate_sql() + f"""l AS ({long_sql()}), f AS ({found}), d AS (SELECT DISTINCT subjectid, timepoint, form, message, unnest(string_split(reports, ',')) AS report FROM f WHERE NOT removed AND inclusion_status = 'included')
 SELECT report, subjectid AS subject, timepoint AS displayed_timepoint, form AS displayed_form, CAST(count(DISTINCT message) AS BIGINT) AS flag_count, string_agg(DISTINCT message, ' | ' ORDER BY message) AS flags, CAST(0 AS INTEGER) AS days_since_detected, bool_or(timepoint = 'screening') AS priority_item,
 'yellow' AS status_class FROM d GROUP BY 1, 2, 3, 4"""


@query(run_sql())
def q_run_flags(spark, sf_dir):
    """A first run from snapshot rows to trackers."""
    of = study_of(spark)
    rows = run.with_subjects(snapshot(spark, sf_dir), people(spark, sf_dir), model.timepoints(spark))
    trackers = run.run(rows, of, due_forms(spark), F.lit("2024-05-01").cast("date")).trackers
    in_order = F.array_join(F.array_sort(F.split("flags", r" \| ")), " | ").alias("flags")
    return trackers.select("report", "subject", "displayed_timepoint", "displayed_form", "flag_count", in_order, "days_since_detected", "priority_item", "status_class")




# the visits of a run: dates of forms that aren't marked missing give ranges, the range check and the withdrawn table

MONITORED = [
    ("first_date", "one", "text", "Date of interview", "", "", "", ""), ("first_missing", "one", "checkbox", "", "", "", "", ""), ("second_date", "two", "text", "Date of interview", "", "", "", ""), ("second_missing", "two", "checkbox", "", "", "", "", ""),
]


def monitored(spark, sf_dir):
    """A run over a row for each customer and year of orders: its first and last order are two forms' dates, the mean of them a medication's modification."""
    made = [(x, f, kind, label if "date" in x else "", f"1, {content.MISSING_TEXT}" if "missing" in x else "", logic, required, "", "", low, high) for x, f, kind, label, logic, required, low, high in MONITORED]
    names = ("variable", "form", "field_type", "label", "choices", "branching_logic", "required", "identifier", "validation", "validation_min", "validation_max")
    of = run.study(spark.createDataFrame([(*m[:3], content.INTERVIEW_TEXTS[0] if m[3] else "", *m[4:]) for m in made], ", ".join(f"{x} string" for x in names)))
    orders = t(spark, sf_dir, "orders").groupBy("o_custkey", (F.year("o_orderdate") - 1992).alias("n")).agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"), F.min("o_orderkey").alias("k"), F.max("o_orderkey").alias("j"))
    name = lambda x: F.get(F.array(*map(F.lit, VISITS)), F.col(x))
    code = lambda x, n: F.when(F.col(x) % n == 0, "1").otherwise("0")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("subjectid"), F.when(F.col("o_custkey") % 3 == 0, "PRESCIENT").otherwise("PRONET").alias("network"), name("n").alias("timepoint"), F.when(F.col("o_custkey") % 11 == 0, "removed").otherwise("month2").alias("visit_status_string"),
        F.col("a").cast("string").alias("first_date"), F.when(F.col("j") % 13 == 0, "1909-09-09").otherwise(F.concat(F.col("b").cast("string"), F.lit(" 10:00"))).alias("second_date"), code("k", 5).alias("first_missing"), code("j", 7).alias("second_missing"),
        F.lit("2").alias("one_complete"), F.lit("2").alias("two_complete"), F.date_add("a", (F.col("k") % 500).cast("int")).cast("string").alias("chrpharm_date_mod"), F.date_add("b", (F.col("j") % 700).cast("int")).cast("string").alias("chrpharm_date_mod_2"),
    )
    info = people(spark, sf_dir).withColumns({"screenfail": F.col("subject").cast("int") % 13 == 0, "completed_study": F.lit(False)})
    due = spark.createDataFrame([(c, x, ["one", "two"] if c == "CHR" else ["one"]) for c in ("HC", "CHR") for x in VISITS], "cohort string, timepoint string, forms array<string>")
    return run.checked(run.with_subjects(rows, info, model.timepoints(spark)), of, due, F.lit("1999-01-01").cast("date"))


MONITOR_SQL = f"""WITH o AS (SELECT o_custkey, year(o_orderdate) - 1992 AS n, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b, min(o_orderkey) AS k, max(o_orderkey) AS j FROM orders GROUP BY 1, 2),
 r AS (SELECT *, CASE WHEN o_custkey % 5 = 0 THEN 'HC' ELSE 'CHR' END AS cohort, {[*VISITS]}[CAST(n AS INTEGER) + 1] AS timepoint FROM o),
 d AS (SELECT o_custkey, n, a AS date FROM r WHERE k % 5 <> 0 UNION ALL SELECT o_custkey, n, b FROM r WHERE j % 7 <> 0 AND j % 13 <> 0 AND cohort = 'CHR'),
 v AS (SELECT o_custkey, n, min(date) AS earliest, max(date) AS latest FROM d GROUP BY 1, 2) """


@query(MONITOR_SQL + f""", l AS (SELECT o_custkey, max(n) AS n, arg_max(latest, n) AS most_recent_date FROM v GROUP BY 1)
 SELECT CAST(o_custkey AS VARCHAR) AS subject, CASE WHEN o_custkey % 3 = 0 THEN 'PRESCIENT' ELSE 'PRONET' END AS network, CASE WHEN o_custkey % 5 = 0 THEN 'HC' ELSE 'CHR' END AS cohort, {[*VISITS]}[CAST(n AS INTEGER) + 1] AS current_timepoint, most_recent_date,
 CAST(CASE WHEN n = 3 AND o_custkey % 5 = 0 THEN 300 ELSE 30 END - date_diff('day', most_recent_date, DATE '1999-01-01') AS BIGINT) AS days_until_expected_next_visit, o_custkey % 11 = 0 AS withdrawn_status
 FROM l WHERE o_custkey % 7 <> 0 AND (o_custkey % 3 = 0 OR o_custkey % 13 <> 0)""")
def q_run_withdrawn(spark, sf_dir):
    return monitored(spark, sf_dir).withdrawn.withColumn("days_until_expected_next_visit", F.col("days_until_expected_next_visit").cast("long"))


@query(MONITOR_SQL + """, p AS (SELECT *, lag(n) OVER w AS pn, lag(earliest) OVER w AS pe, lag(latest) OVER w AS pl FROM v WINDOW w AS (PARTITION BY o_custkey ORDER BY n)),
 m AS (SELECT r.o_custkey, timepoint, CAST(r.a + CAST(k % 500 AS INTEGER) AS DATE) AS d1, CAST(r.b + CAST(j % 700 AS INTEGER) AS DATE) AS d2, earliest, latest, pe, pl FROM r JOIN p USING (o_custkey, n) WHERE n = 0 OR pn = n - 1)
 SELECT CAST(o_custkey AS VARCHAR) AS subjectid, timepoint, 'chrpharm_date_mod : Modified on ' || CAST(d1 AS VARCHAR) || ' and ' || CAST(d2 AS VARCHAR) || ', outside of this and the previous visit' AS error_message
 FROM m WHERE (d1 < least(earliest, pe) OR d1 > greatest(latest, pl)) AND (d2 < least(earliest, pe) OR d2 > greatest(latest, pl))""")
def q_run_visit_range(spark, sf_dir):
    return monitored(spark, sf_dir).flags.where("rule = 'modification date'").select("subjectid", "timepoint", "error_message")


# The dictionary's tables, with parts as a dictionary

PREFIXES = (
    "'chrpharm_med' || k || '_name_past'", "'chrscid_b' || k", "'chrx_vol' || k", "'chrscid_c' || k", "'note' || k", "'chrpharm_med' || k || '_onset'", "'chrblood_pos' || k", "'chrx_id' || k", "'chrerr_date' || k",
    "'v' || k || '_redcap_user'", "'chrpharm_firstdose_med' || k", "'chrpsychs_scr_' || (k % 17) || 'd16_app'", "'chrpharm_med' || k || '_mo1'", "'chrplain' || k", "'chrdemo_racial' || k",
)
TABLE_CELLS = {
    "variable": f"CASE k % {len(PREFIXES)} " + " ".join(f"WHEN {n} THEN {x}" for n, x in enumerate(PREFIXES)) + " END",
    "form": one_of(1, content.BLOOD, content.SCID, content.EXPOSURE, "oasis", "psychs_p1p8", "penncnb", "past_pharmaceutical_treatment", "gcp_form", "other"), "field_type": one_of(2, "text", "notes", "checkbox", "descriptive", "text"),
    "label": one_of(3, "Interview date", "a barcode", "Date of Data Entry", "Other", "<b>x</b>"), "choices": one_of(4, "", content.MISSING_TEXT, content.REASON_TEXT, "1, Yes"), "branching_logic": one_of(0, "", "[x]", ""), "required": one_of(1, "y", ""),
    "identifier": one_of(2, "", "", "", "y"), "validation": "''", "validation_min": one_of(0, "", "1", "-9"), "validation_max": one_of(3, "9", "", "x"),
}


def tables_sql() -> str:
    has = lambda x, *texts: "regexp_matches({}, '{}')".format(x, "|".join(texts))
    inside = lambda x, items: f"{x} IN ({', '.join(repr(i) for i in items)})"
    parts = []
    add = lambda name, where, a="form", b="variable", of="c": parts.append(f"SELECT {'DISTINCT' if 'excluded' in name else ''} {name} AS tbl, {a} AS a, {b} AS b FROM {of} WHERE {where}")
    essential = "(variable LIKE 'chrpsychs_scr_%d16_app' AND k % 17 BETWEEN 1 AND 15)"
    further = f"({essential} OR (variable LIKE '%chrpharm_med%' AND variable LIKE '%name_past%') OR form = '{content.SCID}' OR form = '{content.EXPOSURE}')"
    must = f"(required = 'y' AND field_type <> 'checkbox' AND {inside('form', content.PSYCHS_FORMS).replace(' IN ', ' NOT IN ')})"
    note, own = "field_type IN ('notes', 'descriptive')", inside("form", content.SELF_REPORTS)
    listed = f"identifier <> 'y' AND ({must} OR {further})"
    add("'blank Main Report'", f"{listed} AND (NOT {note} OR {further}) AND NOT {own}")
    add("'blank Secondary Report'", f"{listed} AND ({note} OR {own})")
    for network, forms in content.MISSING_CODE_FORMS.items():
        add(f"'codes {network}'", inside("form", forms), "''")
    names = [*content.EXCLUDED, *(f"chrscid_{x}" for x in content.EXCLUDED_SCID)]
    add("'excluded PRONET'", has("variable", *names), "''")
    add("'excluded PRESCIENT'", f"{has('variable', *names, *content.EXCLUDED_PRESCIENT, *(f'chrscid_s{n}_yn' for n in range(1, 16)))} OR position('gcp' IN form) > 0", "''")
    for report, forms in content.TEAMS.items():
        parts += [f"SELECT 'team {report}', '{f}', ''" for f in forms]
    member = sorted({f for forms in content.TEAMS.values() for f in forms} - {content.SCID})
    add("'team Non Team Forms'", f"NOT {inside('form', member)}", "form", "''", "(SELECT DISTINCT form FROM c)")
    for group, test in {"position": has("variable", "pos"), "id": has("variable", "id"), "volume": has("variable", "vol"), "barcode": has("label", "barcode")}.items():
        add(f"'blood {group}'", f"form = '{content.BLOOD}' AND {test}", "''")
    add("'module module_b'", f"form = '{content.SCID}' AND {has('variable', 'chrscid_b')}", "''")
    add("'module module_c'", f"form = '{content.SCID}' AND {has('variable', 'c[1-9]')}", "''")
    for group, test in {"name": "name", "firstdose": "firstdose", "status": r"^chrpharm_med[0-9]*_mo", "onset": r"^chrpharm_med[0-9]*_onset"}.items():
        add(f"'medication {group}'", f"position('pharmaceutical' IN form) > 0 AND {has('variable', test)}", "''")
    add("'special missing_var'", f"choices = '{content.MISSING_TEXT}'")
    add("'special missing_spec_var'", f"choices = '{content.REASON_TEXT}'")
    add("'special interview_date_var'", f"label = 'Interview date' AND NOT {has('variable', 'err')}")
    add("'special entry_date_var'", f"label = 'Date of Data Entry' AND NOT {has('variable', 'err')}")
    add("'special redcap_user_var'", "variable LIKE '%redcap_user'")
    add("'specific value is 0'", essential)
    add("'always'", "branching_logic = '' AND identifier <> 'y' AND field_type NOT IN ('checkbox', 'notes', 'descriptive')")
    add("'range 1.0 9.0'", "validation_min = '1' AND validation_max = '9'", "''")
    add("'range 0.0 9.0'", "validation_min = '-9' AND validation_max = '9'", "''")
    add("'checkbox'", "field_type = 'checkbox' AND required = 'y'", "''")
    return with_cells(TABLE_CELLS) + " UNION ALL ".join(parts)


@query(tables_sql())
def q_study_tables(spark, sf_dir):
    d = rows_of(spark, sf_dir, TABLE_CELLS).drop("k")
    no = F.lit("")
    named = lambda rows, title, key, a=no: rows.select(F.concat_ws(" ", F.lit(title), F.col(key)).alias("tbl"), a.alias("a"), F.col("variable").alias("b"))
    form = F.col("form")
    ranges = content.dd.ranges(d, {}).withColumn("limits", F.concat_ws(" ", F.col("low").cast("string"), F.col("high").cast("string")))
    out = [
        named(content.blank_checks(d), "blank", "report", form), named(content.missing_code_checks(d), "codes", "network"), named(content.excluded(d), "excluded", "network"),
        content.teams(d).select(F.concat_ws(" ", F.lit("team"), "report").alias("tbl"), form.alias("a"), no.alias("b")), named(content.blood_groups(d), "blood", "grp"), named(content.module_groups(d), "module", "grp"),
        named(content.medication_groups(d), "medication", "grp"), named(content.special_variables(d), "special", "kind", form), named(content.specific_values(d), "specific", "message", form),
        content.dd.always_shown(d).select(F.lit("always").alias("tbl"), form.alias("a"), F.explode("non_branch_logic_vars").alias("b")), named(ranges, "range", "limits"),
        content.dd.required_checkboxes(d).select(F.lit("checkbox").alias("tbl"), no.alias("a"), F.col("variable").alias("b")),
    ]
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    return found

import pytest

from pyspark.sql import functions as F

from tallyward.functions import predicates

ROWS = [("1", "2", ""), ("1.0", "1", "x"), ("", "2", "00"), ("a", "-9", "0"), (None, "3", None)]

CASES = [
    ("[a]='1'", [True, True, False, False, False]),
    ("[a]<>'1'", [False, False, True, True, True]),
    ("[c]<>''", [False, True, True, True, False]),
    ("[c]=''", [True, False, False, False, True]),
    ("[c]='00'", [False, False, True, False, False]),
    ("[a]=[b]", [False, True, False, False, False]),
    ("[a]<[b]", [True, False, False, False, False]),
    ("[b]>=2", [True, False, True, False, True]),
    ("[gone]='1'", [False] * 5),
    ("[gone]<>'1'", [True] * 5),
    ("[a]='1' and [b]>'1'", [True, False, False, False, False]),
    ("([a]='1' or [c]='00')", [True, True, True, False, False]),
    ("", [True] * 5),
]


@pytest.mark.parametrize(("logic", "expected"), CASES)
def test_predicates_are_two_valued(spark, logic, expected):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, a string, b string, c string")
    compiled = predicates.compiled(spark.createDataFrame([("v", logic)], "variable string, branching_logic string")).first()
    assert compiled["rest"] == ""
    got = rows.orderBy("i").select(F.expr(predicates.applicable(compiled["predicate"], rows.columns).text)).collect()
    assert [r[0] for r in got] == expected


def test_unsupported_parts_are_reported_and_overrides_win(spark):
    d = spark.createDataFrame([("v", "datediff([a],[b])>3 and [c]='1'"), ("w", "[x(2)]='1'")], "variable string, branching_logic string")
    own = spark.createDataFrame([("v", "true")], "variable string, predicate string")
    rest = {r["variable"]: r["rest"] for r in predicates.compiled(d).collect()}
    assert rest["v"] and rest["w"] == ""
    out = {r["variable"]: r for r in predicates.compiled(d, own).collect()}
    assert out["v"]["predicate"] == "true" and out["v"]["rest"] == "" and "x___2" in out["w"]["predicate"]

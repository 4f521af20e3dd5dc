import math

import pytest
from pyspark.sql import functions as F

from tallyward.functions import values as v


def cells(spark, values):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string")


def column(spark, values, expression):
    return [r[0] for r in cells(spark, values).orderBy("i").select(expression).collect()]


def python_float(x):
    try:
        y = float(x)
    except (TypeError, ValueError):
        return None
    return y if math.isfinite(y) and "_" not in x else None


TEXTS = ["2", "2.0", "02", " 5 ", "1d", "1f", "-9", "+3", ".5", "5.", "1e3", "1E-2", "", "abc", "NaN", "inf", "1,5", "0x10", None, "--1", "1 2"]


def test_numbers_read_as_python_reads_them(spark):
    assert column(spark, TEXTS, v.num("x")) == [None if x is None else python_float(x) for x in TEXTS]


def test_missing_codes_in_all_spellings(spark):
    texts = ["-3", "-9.0", "999", "-99", "99", "1909-09-09", "1903-03-03", "1910-01-01", "", None]
    assert column(spark, texts, v.is_missing("x")) == [True, True, True, True, False, True, True, False, False, False]
    assert column(spark, texts, v.is_empty("x")) == [True, True, True, True, False, True, True, False, True, False]
    assert column(spark, ["2", "2.00", "3", "", None], v.is_code("x", 2)) == [True, True, False, False, False]


def test_dates_are_strict(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-02-30", " 2024-01-05", "2024-01-05T00:00", "2024-01-05 10:00", "20240105", "", None]
    assert [d and str(d) for d in column(spark, texts, v.as_date("x"))] == ["2024-01-05", "2024-01-05", None, None, None, None, None, None, None]
    assert str(column(spark, ["2024-01-05 10:00"], v.as_date("x", cut=True))[0]) == "2024-01-05"
    assert column(spark, ["2024/01/05T1"], v.days_since("x", F.lit("2024-01-10").cast("date"))) == [5]


def test_classes_and_labels(spark):
    texts = ["-9", "4", "2024-01-05 x", "", "word", None]
    assert column(spark, texts, v.value_class("x")) == ["missing", "number", "date", "blank", "text", "other"]
    assert column(spark, ["<b>A</b>/b\nc<br/>"], v.strip_tags("x")) == ["Abc"]
    assert v.network_completion("psychs_hc_complete") == "psychs_complete_rpms"
    assert column(spark, ["screen", "baseln", "month1"], v.timepoint_alias("x")) == ["screening", "baseline", "month1"]


@pytest.mark.parametrize(("days", "resolved", "manual", "expected"), [(3, False, False, "yellow"), (7, False, False, "orange"), (14, False, False, "red"), (None, False, False, "grey"), (3, True, False, "green"), (3, True, True, "blue")])
def test_freshness(spark, days, resolved, manual, expected):
    row = spark.range(1).select(v.freshness(F.lit(days).cast("int"), F.lit(resolved), F.lit(manual)))
    assert row.first()[0] == expected

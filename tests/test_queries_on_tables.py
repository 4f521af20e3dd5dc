"""Queries against their SQL over small tables made for one case each."""

import duckdb

import __spark_entry__ as entry


def differs(spark, folder, name, tables):
    """The rows of only one side; tables: name -> (schema, rows)."""
    base = duckdb.connect()
    for table, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).toPandas().to_parquet(f"{folder}/{table}.parquet")
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = entry.queries()[name](spark, str(folder))
    expected = {tuple(r) for r in base.sql(f"SELECT {', '.join(found.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()}
    assert expected
    return {tuple(r) for r in found.collect()} ^ expected


def test_sums_that_look_like_missing_codes_or_end_in_half_cents(spark, tmp_path):
    lines = [(1, 999.0), (2, 400.0), (2, 599.0), (3, 1.005), (4, 500.0), (5, 1000.125), (6, 10.075)]
    orders = [(1, 2000.0), (2, 500.5), (3, 7.5), (4, 999.0), (5, 5000.0), (6, 1.0)]
    tables = {"lineitem": ("l_orderkey long, l_extendedprice double", lines), "orders": ("o_orderkey long, o_totalprice double", orders)}
    assert not differs(spark, tmp_path, "q_tolerance", tables)

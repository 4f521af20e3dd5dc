"""Flags as a state that a run reads without moving it: a table bucketed by the flags' keys, resolved ones in partitions of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.operators.lifecycle import KEYS, keyed

BUCKETS = 200


def _location(path: str, run_date: str) -> str:
    return f"{path.rstrip('/')}/run_date={run_date}"


def save(flags: DataFrame, path: str, run_date: str, name: str = "flag_state", buckets: int = BUCKETS, keys=KEYS) -> DataFrame:
    """Writes the flags after a run as the state of its date (W2, S6, S7); a run of the same date replaces its own state."""
    spark, table = flags.sparkSession, _table(name, run_date)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    held = keyed(flags, keys) if "flag_key" not in flags.columns else flags
    held = held.repartition(buckets, "flag_key")  # a file for each bucket
    held.write.format("parquet").mode("overwrite").option("path", _location(path, run_date)).partitionBy("currently_resolved").bucketBy(buckets, "flag_key").sortBy("flag_key").saveAsTable(table)
    return spark.table(table)


def load(spark: SparkSession, path: str, run_date: str, name: str = "flag_state", buckets: int = BUCKETS) -> DataFrame:
    """The state of a date; the catalogue of another session learns of it from the files."""
    table = _table(name, run_date)
    if not spark.catalog.tableExists(table):
        schema = spark.read.parquet(_location(path, run_date)).schema
        columns = ", ".join(f"`{f.name}` {'boolean' if f.name == 'currently_resolved' else f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (currently_resolved) CLUSTERED BY (flag_key) SORTED BY (flag_key) INTO {buckets} BUCKETS LOCATION '{_location(path, run_date)}'")
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def _table(name: str, run_date: str) -> str:
    return f"{name}_{run_date.replace('-', '')}"

"""Tables that a run writes once and reads several times."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset and driver and executors are one process, a temporary one is set."""
    set_to = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_to = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


@contextlib.contextmanager
def compilable(spark: SparkSession):
    """Plans of many expressions are run operator by operator where one method for all would outgrow HotSpot's 8,000 bytes, beyond which it is interpreted (Spark's own limit is 65,535)."""
    before = spark.conf.get(METHOD_LIMIT, None)
    spark.conf.set(METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before) if before else spark.conf.unset(METHOD_LIMIT)


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """df as a table in the shared folder, partitioned by some columns: its plan runs once, and lost executors don't bring it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with compilable(df.sparkSession):
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

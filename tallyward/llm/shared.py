"""Where jobs keep their intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; if it is unset, a temporary one is set where driver and executors are one process (tests)."""
    set_to = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_to = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: this cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sampled(hashed: Column, wanted: int, of: int) -> Column:
    """True for about `wanted` of `of` rows, by a bound on a 64-bit hash: the same rows each time, and no sort.  All rows if there are no more."""
    if of <= wanted:
        return F.lit(True)
    return F.shiftrightunsigned(hashed, 32) < F.lit(int((1 << 32) * wanted / of))


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that `kept` made, once all that reads it has been written."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)

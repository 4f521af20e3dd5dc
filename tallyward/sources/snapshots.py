"""Reading snapshots, dictionaries and their kin.

Everything is read as text.  A file's blank cells become '' before files are united, so that null afterwards means "the file has no such column".
"""

from __future__ import annotations

import csv
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_NAME = r"combined-([A-Za-z]+)-([A-Za-z0-9]+)-day1to1\.csv"

# The dictionary's columns.
DICTIONARY_COLUMNS = {
    "Variable / Field Name": "variable", "Form Name": "form", "Field Type": "field_type", "Field Label": "label", "Choices, Calculations, OR Slider Labels": "choices",
    "Branching Logic (Show field only if...)": "branching_logic", "Required Field?": "required", "Identifier?": "identifier",
    "Text Validation Type OR Show Slider Number": "validation", "Text Validation Min": "validation_min", "Text Validation Max": "validation_max",
}


def read_text(spark: SparkSession, path, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """CSV files of one header, all text, blanks as ''.

    With the columns given there is no job for the header.  Files whose cells hold no line feeds split over tasks with `multi_line` off.
    """
    schema = StructType([StructField(c, StringType()) for c in columns]) if columns else None
    return spark.read.csv(path, header=True, schema=schema, inferSchema=False if schema is None else None, multiLine=multi_line, escape='"').na.fill("")


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, from one job over all of them."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("row")).where("_metadata.file_block_start = 0")
    first = lines.groupBy("path").agg(F.min_by("value", "row").alias("header")).orderBy("path").collect()  # a row for each file
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first:
        out.setdefault(tuple(next(csv.reader([r["header"].lstrip("\ufeff")]))), []).append(r["path"])
    return out


def read_snapshots(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """All snapshots, one read for each header; network and timepoint come from the file's name."""
    parts = []
    for columns, files in headers(spark, paths).items():
        df = read_text(spark, files, list(columns), multi_line).withColumn("_file", F.input_file_name())
        parts.append(df.withColumns({"network": F.upper(F.regexp_extract("_file", _NAME, 1)), "timepoint": F.regexp_extract("_file", _NAME, 2)}).drop("_file"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def newest(paths: list[str]) -> str:
    """The file whose name holds the latest date (yyyy-mm-dd); those without one come first."""
    return max(paths, key=lambda p: (re.findall(r"\d{4}-\d{2}-\d{2}", p.rsplit("/", 1)[-1])[-1:], p))


def read_dictionary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The data dictionary under short names; of several files the newest by name."""
    df = read_text(spark, newest(path) if isinstance(path, list) else path)
    return df.withColumnsRenamed({k: n for k, n in DICTIONARY_COLUMNS.items() if k in df.columns})


def read_metadata(spark: SparkSession, path, schema) -> DataFrame:
    """S3: derived metadata as JSON; what doesn't parse is left out, and a malformed file has no rows."""
    return spark.read.json(path, schema=schema, multiLine=True, mode="DROPMALFORMED")


def write_metadata(rows: DataFrame, path: str) -> None:
    """S3: derived metadata as JSON, replaced as a whole."""
    rows.write.mode("overwrite").json(path)


def read_raters(spark: SparkSession, paths) -> DataFrame:
    """Rater -> subjects, without blanks and repeats."""
    rows = read_text(spark, paths).where("RAname != '' and subjectkey != ''").select(F.col("RAname").alias("rater"), F.col("subjectkey").alias("subject")).distinct()
    return rows.groupBy("rater").agg(F.array_sort(F.collect_set("subject")).alias("subjects"))


def read_conversions(spark: SparkSession, paths, subject: str = r"([A-Z]{2}[0-9]{5})") -> DataFrame:
    """The first row's conversion date of each subject's status file, dd/MM/yyyy as ISO."""
    rows = read_text(spark, paths).select(F.col("Transition / Conversion").alias("raw"), F.regexp_extract(F.input_file_name(), subject, 1).alias("subject"), F.monotonically_increasing_id().alias("row"))
    first = rows.groupBy("subject").agg(F.min_by("raw", "row").alias("raw"))
    return first.select("subject", F.date_format(F.try_to_timestamp("raw", F.lit("dd/MM/yyyy")), "yyyy-MM-dd").alias("conversion_date"))


def read_changes(spark: SparkSession, paths) -> DataFrame:
    """Daily change files, with the date of the file's name."""
    return read_text(spark, paths).withColumn("date", F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})", 1))


def read_reviews(spark: SparkSession, paths) -> DataFrame:
    """Reviewer sheets under the internal names."""
    names = {"Participant": "subject", "Timepoint": "displayed_timepoint", "Form": "displayed_form", "Flags": "flags", "Manually Resolved": "manually_resolved", "Network Comments": "comments", "Site Comments": "site_comments"}
    return read_text(spark, paths).withColumnsRenamed(names)

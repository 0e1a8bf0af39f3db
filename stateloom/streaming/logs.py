"""Failed work units recovered from error logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The log format.
SEPARATOR_LINE = r"(?m)^--[ \t]*\r?$"
FAILED_QUERY = r"(?sm)\(query:\s*(.+?)\)\s*$"
FILE_NAME = r"/(\d+\.parquet)"


def extract_failed_units(spark: SparkSession, folder: str, newline: str = "\n") -> DataFrame:
    """The failed queries of all logs in a folder, with the file each one read.

    Entries are separated by lines that are exactly ``--``; such a line never
    occurs inside SQL text, unlike the comment marker. The separator is given to
    the reader as its record delimiter, so a large log is split over many tasks
    and never held as one value; give ``newline="\\r\\n"`` for logs with such line
    endings. The split by pattern then only has to deal with the first and last line
    of a file, and with files that use other line endings than the rest.
    """
    records = spark.read.text(folder, lineSep=f"{newline}--{newline}").select(
        F.col("_metadata.file_name").alias("log"), "value"
    )
    entries = records.select(
        "log", F.explode(F.split("value", SEPARATOR_LINE)).alias("entry")
    ).select("log", F.regexp_extract("entry", FAILED_QUERY, 1).alias("query"))
    name = F.regexp_extract("query", FILE_NAME, 1)
    return entries.where(F.col("query") != "").select(
        "log",
        F.trim("query").alias("query"),
        F.when(name != "", name).otherwise("unknown").alias("file_name"),
    )

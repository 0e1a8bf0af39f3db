"""Bulk load of a folder of Parquet files, with an account per file."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stateloom.schemas import PLAIN_ACCOUNTS
from stateloom.sources.files import SPARK_ERRORS, shared_dir
from stateloom.sources.transient import is_transient

log = logging.getLogger(__name__)

ROWS_PER_FILE = 1_000_000
ATTEMPTS = 3
#: Content of a file without rows that a task reads to see whether it announces any.
SUSPECT_BYTES = 64 << 20
_REPORT = "path string, file string, rows long, status string, error string"


@dataclass
class Loaded:
    """A loaded table, and what became of each file."""

    table: DataFrame
    report: DataFrame


class PartialLoad(RuntimeError):
    """Some files could not be read and partial loads were not allowed; ``report`` says which."""

    def __init__(self, report: DataFrame):
        failed = [f"{r['path']}: {r['error']}" for r in report.where("status = 'failed'").limit(20).collect()]
        super().__init__("files that cannot be read: " + "; ".join(failed))
        self.report = report


def _options(reader, skip_unreadable: bool = False):
    return (
        reader.option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
    )


def _rows(spark: SparkSession, schema: StructType, paths: list[str], skip_unreadable: bool) -> DataFrame:
    return _options(spark.read.schema(schema), skip_unreadable).parquet(*paths)


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every file under the paths; files are told apart by their full path, in the one form that all scans have."""
    return _options(spark.read.format("binaryFile")).load(paths).select(
        F.col("_metadata.file_path").alias("uri"),
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
    )


def _announced(rows: DataFrame) -> DataFrame:
    """Rows per file by its footer: a scan of no column."""
    return rows.groupBy("uri").agg(F.count(F.lit(1)).alias("announced"))


def _footer_problems(spark: SparkSession, paths: list[str], suspects: DataFrame) -> DataFrame:
    """Why files that yielded no row are broken: path and problem, without a row for those that announce none.

    Footers are read in tasks, by content. A file beyond ``SUSPECT_BYTES`` from which no row
    can be read counts as broken.
    """

    def problems(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for content in batch.column("content").to_pylist():
                try:
                    announced = pq.read_metadata(pa.BufferReader(content)).num_rows
                    found.append("no row could be read" if announced else None)
                except (pa.ArrowException, OSError, ValueError) as error:
                    found.append(f"unreadable footer: {str(error).splitlines()[0] if str(error) else type(error).__name__}")
            yield pa.record_batch({"path": batch.column("path").cast(pa.string()), "problem": pa.array(found, pa.string())})

    small = F.col("length") <= SUSPECT_BYTES
    content = _options(spark.read.format("binaryFile")).load(paths).where(small).select("path", "content")
    read = content.join(suspects, "path", "left_semi").mapInArrow(problems, "path string, problem string")
    # What was not read was too large.
    large = F.coalesce("problem", F.when(F.col("seen").isNull(), "no row could be read"))
    known = suspects.join(read.withColumn("seen", F.lit(True)), "path", "left").select("path", large.alias("problem"))
    return known.where("problem is not null")


def _examine(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """One row per file under the paths: path, file, rows, status and error."""
    listing = _listing(spark, paths)
    columns = [F.col(name) for name in schema.fieldNames()]
    rows = _rows(spark, schema, paths, True).select("*", F.col("_metadata.file_path").alias("uri"))
    announced = _announced(rows)
    # The digest is used, so the columns have to be decoded to count a row.
    decoded = (
        rows.groupBy("uri")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*columns)).alias("digest"))
        .select("uri", F.when(F.col("digest").isNotNull(), F.col("n")).alias("decoded"))
    )
    zero = F.lit(0)
    counted = listing.join(announced, "uri", "left").join(decoded, "uri", "left").select(
        "path", "file", F.coalesce("announced", zero).alias("announced"), F.coalesce("decoded", zero).alias("decoded")
    )
    target = f"{shared_dir(spark)}/counted"
    counted.write.parquet(target)
    counted = spark.read.schema(counted.schema).parquet(target)
    # Files without any row are empty or broken; of these alone the footers are opened.
    suspects = counted.where("announced = 0").select("path")
    if suspects.isEmpty():
        known = spark.createDataFrame([], "path string, problem string")
    else:
        known = _footer_problems(spark, paths, suspects)
    short = F.when(
        F.col("decoded") < F.col("announced"),
        F.format_string("read %d of %d rows", "decoded", "announced"),
    )
    report = counted.join(known, "path", "left").withColumn("error", F.coalesce("problem", short))
    failed = F.col("error").isNotNull()
    return report.select(
        "path",
        "file",
        F.when(failed, 0).otherwise(F.col("decoded")).cast("long").alias("rows"),
        F.when(failed, "failed").otherwise("loaded").alias("status"),
        "error",
    )


def load_report(
    spark: SparkSession,
    folder: str,
    schema: StructType = PLAIN_ACCOUNTS,
    attempts: int = ATTEMPTS,
    delay: float = 1.0,
) -> DataFrame:
    """One row per file of a folder and its subfolders: path, file, rows, status and error.

    A file is loaded when all rows its footer announces can be decoded. Both
    counts come from Spark scans that skip what they cannot read: one reads no
    column (footers only), one decodes the wanted columns. Such a scan also skips
    a sound file over a passing error, so files that failed are read again, and
    those alone, before they are called broken. The report is stored.
    """
    target = f"{shared_dir(spark)}/report"
    _examine(spark, [folder], schema).write.parquet(f"{target}/try-1")
    report = spark.read.schema(_REPORT).parquet(f"{target}/try-1")
    for attempt in range(2, attempts + 1):
        failed = [r["path"] for r in report.where("status = 'failed'").select("path").collect()]
        if not failed:
            break
        time.sleep(delay)
        again = report.where("status = 'loaded'").unionByName(_examine(spark, failed, schema))
        again.write.parquet(f"{target}/try-{attempt}")
        report = spark.read.schema(_REPORT).parquet(f"{target}/try-{attempt}")
    return report


def load_summary(report: DataFrame) -> DataFrame:
    """Totals of a report: files, failures, success rate in percent, rows."""
    good = F.count_if(F.col("status") == "loaded")
    return report.agg(
        F.count(F.lit(1)).alias("files"),
        good.alias("loaded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.round(100.0 * good / F.count(F.lit(1)), 1).alias("success_rate"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
    )


def _write(rows: DataFrame, target: str, mode: str) -> int:
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(target)
    return seen.get["rows"]


def _sound_report(spark: SparkSession, folder: str, schema: StructType, written: int) -> DataFrame | None:
    """The report of a strict load, by footers alone; None if they do not add up to the rows written."""
    rows = _rows(spark, schema, [folder], False).select(F.col("_metadata.file_path").alias("uri"))
    report = _listing(spark, [folder]).join(_announced(rows), "uri", "left").select(
        "path",
        "file",
        F.coalesce("announced", F.lit(0)).cast("long").alias("rows"),
        F.lit("loaded").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    target = f"{shared_dir(spark)}/report"
    report.write.parquet(target)
    report = spark.read.schema(_REPORT).parquet(target)
    return report if report.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] == written else None


def load_parquet_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    schema: StructType = PLAIN_ACCOUNTS,
    mode: str = "append",
    allow_partial: bool = False,
    attempts: int = ATTEMPTS,
    delay: float = 1.0,
) -> Loaded:
    """Copy all rows of a folder's Parquet files into a table; returns it with a report.

    One strict job does it when every file is sound, since it fails at any row that
    cannot be decoded: the report then takes the rows of each file from its footer, and
    their sum has to be what was written. Passing errors are tried again. If it keeps failing, the files are examined. Broken ones raise
    ``PartialLoad`` before anything is written, unless partial loads are allowed:
    then the sound files are loaded, a broken file contributes no row at all, and
    the rows that arrive must be those of the report.
    """
    failure = None
    for attempt in range(attempts):
        try:
            written = _write(_rows(spark, schema, [folder], False), target, mode)
        except SPARK_ERRORS as error:
            failure = error
            if not is_transient(error) or attempt + 1 == attempts:
                break
            time.sleep(delay)
            continue
        report = _sound_report(spark, folder, schema, written)
        if report is None:
            report = load_report(spark, folder, schema)
        return Loaded(spark.read.schema(schema).parquet(target), report)
    if "PATH_NOT_FOUND" in str(failure):
        raise failure
    report = load_report(spark, folder, schema, attempts, delay)
    broken = report.where("status = 'failed'")
    if broken.isEmpty():
        raise failure  # every file is sound: the fault lies elsewhere
    if not allow_partial:
        raise PartialLoad(report)
    wanted = report.where("status = 'loaded'").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    for attempt in range(1, attempts + 1):
        staged = f"{shared_dir(spark)}/staged"
        sound = _options(spark.read.format("binaryFile")).load(folder).select(
            F.col("_metadata.file_path").alias("uri"), "path"
        )
        sound = sound.join(report.where("status = 'loaded'").select("path"), "path", "left_semi").select("uri")
        rows = _rows(spark, schema, [folder], True).select("*", F.col("_metadata.file_path").alias("uri"))
        got = _write(rows.join(sound, "uri", "left_semi").drop("uri"), staged, "errorifexists")
        if got == wanted:
            _write(spark.read.schema(schema).parquet(staged), target, mode)
            return Loaded(spark.read.schema(schema).parquet(target), report)
        log.warning("%s: %d of %d rows arrived (try %d)", folder, got, wanted, attempt)
        time.sleep(delay)
    raise RuntimeError(f"{folder}: sound files cannot be read in full")

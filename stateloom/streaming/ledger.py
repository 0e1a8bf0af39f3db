"""The record of what was processed: one row per attempt at a block range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stateloom.operators.stretches import Interval, settle
from stateloom.sources import files
from stateloom.sources.transient import PASSING

COLUMNS = {
    "table": "string",
    "lower": "bigint",
    "upper": "bigint",
    "status": "string",
    "rows": "bigint",
    "seconds": "double",
    "note": "string",
    "error": "string",
    "attempt": "int",
    "run_id": "bigint",
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
DONE, FAILED = "done", "failed"

class Ledger:
    """Rows as they were recorded, one file each, behind a compacted base.

    ``base=N`` holds all rows up to a compaction and counts once Spark's commit
    marker is there; ``since=N`` holds what came behind it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _base(self) -> int:
        """The newest complete base, 0 before the first compaction."""
        names = [n for n in files.children(self.spark, self.path) if n.startswith("base=")]
        done = [n for n in names if files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return max((int(n.split("=")[1]) for n in done), default=0)

    def record(self, **entry) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            *(F.lit(entry[name]).cast(kind).alias(name) for name, kind in COLUMNS.items())
        )
        row.write.mode("append").parquet(f"{self.path}/since={self._base()}")

    def entries(self) -> DataFrame:
        base = self._base()
        paths = [f"{self.path}/{part}={base}" for part in ("base", "since")]
        paths = [p for p in paths if files.exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths)

    def compact(self, files_at_least: int = 1) -> None:
        """Put all rows into one file if so many were recorded since the last time."""
        base = self._base()
        recorded = [
            n for n in files.children(self.spark, f"{self.path}/since={base}") if n.startswith("part-")
        ]
        if len(recorded) < files_at_least:
            return
        self.entries().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base={base + 1}")
        for part in ("base", "since"):
            files.delete(self.spark, f"{self.path}/{part}={base}")

    def latest(self) -> DataFrame:
        """The last attempt at every range."""
        entries = self.entries()
        keys = ["table", "lower", "upper"]
        rest = [c for c in entries.columns if c not in keys]
        newest = entries.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), F.struct("run_id", "attempt")).alias("last")
        )
        return newest.select(*keys, "last.*").select(*entries.columns)

    def latest_of_run(self) -> DataFrame:
        """The last attempt of every run at every range."""
        entries = self.entries()
        keys = ["run_id", "table", "lower", "upper"]
        rest = [c for c in entries.columns if c not in keys]
        newest = entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), "attempt").alias("last"))
        return newest.select(*keys, "last.*").select(*entries.columns)

    def covered(self) -> dict[str, list[Interval]]:
        """Per table the stretches that are done, by the latest attempt at every block.

        The record has one row per chunk and attempt, which the driver reads.
        """
        rows = self.entries().select("table", "lower", "upper", "status", "run_id", "attempt")
        attempts: dict[str, list] = {}
        for row in rows.orderBy("run_id", "attempt", "lower").toLocalIterator():
            attempts.setdefault(row["table"], []).append(
                (row["lower"], row["upper"], row["status"] == DONE, row["run_id"])
            )
        return {table: settle(list_) for table, list_ in attempts.items()}

    def failed(self, transient_only: bool = False) -> DataFrame:
        """Ranges whose last attempt failed and that no later range made up for."""
        rows = self.latest().where(F.col("status") == FAILED)
        if transient_only:
            rows = rows.where(F.regexp_like("error", F.lit(f"(?i){PASSING}")))
        done = self.entries().where(F.col("status") == DONE).alias("done")
        made_up = (
            (F.col("done.table") == F.col("failed.table"))
            & (F.col("done.lower") <= F.col("failed.lower"))
            & (F.col("done.upper") >= F.col("failed.upper"))
            & (F.col("done.run_id") >= F.col("failed.run_id"))
        )
        return rows.alias("failed").join(done, made_up, "left_anti")


def standing(entries: DataFrame) -> DataFrame:
    """Attempts that no later run covers: overlapping ranges count once."""
    later = entries.select("table", "lower", "upper", "run_id").alias("later")
    covers = (
        (F.col("later.table") == F.col("own.table"))
        & (F.col("later.lower") <= F.col("own.lower"))
        & (F.col("later.upper") >= F.col("own.upper"))
        & (F.col("later.run_id") > F.col("own.run_id"))
    )
    return entries.alias("own").join(later, covers, "left_anti")


def range_report(entries: DataFrame) -> DataFrame:
    """Progress per range: blocks, speed, and the share of its table done by then."""
    rows = standing(entries).withColumn("blocks", F.col("upper") - F.col("lower") + 1)
    whole = Window.partitionBy("table")
    so_far = whole.orderBy("lower").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = F.when(F.col("status") == DONE, F.col("blocks")).otherwise(0)
    return rows.select(
        "table",
        "lower",
        "upper",
        "blocks",
        "status",
        "rows",
        "note",
        F.round(100.0 * F.sum(done).over(so_far) / F.sum("blocks").over(whole), 2).alias("progress"),
        "seconds",
        F.round(F.col("blocks") / F.nullif("seconds", F.lit(0.0)), 2).alias("blocks_per_second"),
    )


def run_report(entries: DataFrame) -> DataFrame:
    """Totals per run and table: ranges, failures, blocks, rows, time and speed of that run alone."""
    done = F.col("status") == DONE
    blocks = F.when(done, F.col("upper") - F.col("lower") + 1).otherwise(0)
    return (
        entries.groupBy("run_id", "table")
        .agg(
            F.count(F.lit(1)).alias("ranges"),
            F.count_if(F.col("status") == FAILED).alias("failed"),
            F.sum(blocks).alias("blocks"),
            F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).cast("long").alias("rows"),
            F.round(F.sum("seconds"), 3).alias("seconds"),
        )
        .withColumn("blocks_per_second", F.round(F.col("blocks") / F.nullif("seconds", F.lit(0.0)), 2))
    )

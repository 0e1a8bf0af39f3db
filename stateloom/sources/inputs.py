"""The canonical inputs of a plan and how they are scanned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stateloom.operators.blocks import in_range
from stateloom.operators.dedup import latest_per_key
from stateloom.schemas import SOURCES


def scan_block_range(
    df: DataFrame,
    start: int | None,
    end: int | None,
    columns: Sequence[str] | None = None,
    bucket_width: int | None = None,
) -> DataFrame:
    """Rows of a block range (both ends included), reading only the named columns."""
    rows = in_range(df, start, end, bucket_width)
    return rows.select(*columns) if columns else rows


class Inputs:
    """Named input tables, with what is known about their versions and partitions.

    ``versions`` names the column that orders the copies of a row; a table
    without one may still hold exact copies. ``bucket_widths`` names tables that
    are partitioned by ``block_bucket`` and how many blocks a bucket covers.
    ``keys`` adds or replaces the columns that identify a row.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        versions: Mapping[str, str] | None = None,
        bucket_widths: Mapping[str, int] | None = None,
        keys: Mapping[str, Sequence[str]] | None = None,
    ):
        self.tables = dict(tables)
        self.versions = dict(versions or {})
        self.bucket_widths = dict(bucket_widths or {})
        self.keys = {name: spec.keys for name, spec in SOURCES.items()} | dict(keys or {})

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, prefix: str = "", names: Sequence[str] | None = None, **known
    ) -> "Inputs":
        """Read ``root/<prefix><name>`` for every canonical table (or the named ones)."""
        widths = known.get("bucket_widths") or {}
        tables = {}
        for name in names or SOURCES:
            schema = SOURCES[name].schema
            version = (known.get("versions") or {}).get(name)
            if version and version not in schema.fieldNames():
                schema = StructType(list(schema)).add(version, "long")
            if name in widths:
                schema = StructType(list(schema)).add("block_bucket", "long")
            tables[name] = spark.read.schema(schema).parquet(f"{root}/{prefix}{name}")
        return cls(tables, **known)

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, prefix: str = "", names: Sequence[str] | None = None, **known
    ) -> "Inputs":
        """Use the session's tables ``<prefix><name>``; the prefix may name a database."""
        return cls({name: spark.table(f"{prefix}{name}") for name in names or SOURCES}, **known)

    def with_tables(
        self, tables: Mapping[str, DataFrame], bucket_widths: Mapping[str, int] | None = None
    ) -> "Inputs":
        return Inputs(
            self.tables | dict(tables),
            self.versions,
            self.bucket_widths | dict(bucket_widths or {}),
            self.keys,
        )

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"unknown input table: {name}")
        return self.tables[name]

    def empty(self, schema: StructType) -> DataFrame:
        session = next(iter(self.tables.values())).sparkSession
        return session.createDataFrame([], schema)

    def scan(
        self, name: str, start: int | None = None, end: int | None = None, *columns: str
    ) -> DataFrame:
        """The stored rows of a range, copies included.

        Enough wherever only key columns are read and the aggregate ignores
        repeats (min, max, distinct, semi join): merging copies first would
        shuffle the whole log for the same answer.
        """
        return scan_block_range(
            self.table(name), start, end, columns, self.bucket_widths.get(name)
        )

    def latest(
        self, name: str, start: int | None = None, end: int | None = None, *columns: str
    ) -> DataFrame:
        """The newest copy of every row of a range: its keys and the named columns."""
        keys = self.keys[name]
        values = [c for c in columns or self.table(name).columns if c not in keys]
        return latest_per_key(self.scan(name, start, end), keys, self.versions.get(name), values, few=True)

    def current(
        self, name: str, start: int | None = None, end: int | None = None, *columns: str
    ) -> DataFrame:
        """Rows of a range with outdated copies removed; exact copies may stay.

        For aggregates that ignore repeats: the merge is only needed where the
        table has a version and a column is read that is not part of its key. Copies
        are merged within the range, so a row is expected to keep to one range.
        """
        if name in self.versions and set(columns) - set(self.keys[name]):
            return self.latest(name, start, end, *columns).select(*columns)
        return self.scan(name, start, end, *columns)

    def max_block(self, name: str) -> DataFrame:
        """One row: the last block of a table, 0 when it is empty."""
        return max_block(self.table(name), name in self.bucket_widths)

    def last_block(self, name: str) -> DataFrame:
        """One row: the last block of a table, null when it is empty."""
        return last_block(self.table(name), name in self.bucket_widths)


def last_block(df: DataFrame, bucketed: bool = False) -> DataFrame:
    """One row ``last_block``, null for an empty table; a bucketed one is read in its last bucket only.

    The bucket is found in the names of the partitions, which the scan lists anyway.
    """
    if bucketed:
        last = last_bucket(df)
        df = df.where(F.lit(False)) if last is None else df.where(F.col("block_bucket") == last)
    return df.agg(F.max("block_number").cast("long").alias("last_block"))


def last_bucket(df: DataFrame) -> int | None:
    """The largest ``block_bucket`` among the directories of a scan that hold files."""
    names = [p.split("block_bucket=")[1].split("/")[0] for p in df.inputFiles() if "block_bucket=" in p]
    if names:
        return max(int(n) for n in names)
    return df.agg(F.max("block_bucket")).first()[0]


def max_block(df: DataFrame, bucketed: bool = False) -> DataFrame:
    """One row ``max_block``, 0 for an empty table."""
    return last_block(df, bucketed).select(F.coalesce("last_block", F.lit(0)).cast("long").alias("max_block"))

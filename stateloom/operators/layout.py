"""Physical placement of rows before a write.

``REBALANCE`` lets adaptive execution cut an oversized target partition into
several tasks and merge small ones, so neither the number of directories nor a
hot address bounds the parallelism of a write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.operators.blocks import BUCKET, bucket_of
from stateloom.schemas import ADDRESS_PARTITIONS, BLOCKS_PER_BUCKET

ADDRESS_PART = "address_part"


def hash_layout(
    df: DataFrame, sort_by: Sequence[str] = ("address", "block_number"), n: int = ADDRESS_PARTITIONS
) -> DataFrame:
    """Place rows by hash of the address into ``n`` partitions, sorted inside each file."""
    placed = df.withColumn(ADDRESS_PART, F.pmod(F.xxhash64("address"), F.lit(n)).cast("int"))
    return placed.hint("rebalance", F.col(ADDRESS_PART)).sortWithinPartitions(ADDRESS_PART, *sort_by)


def hash_layout_composite(
    df: DataFrame, keys: Sequence[str] = ("address", "slot_key"), n: int | None = None
) -> DataFrame:
    """Distribute rows by the composite key: a popular address spreads over all its slots."""
    columns = [F.col(k) for k in keys]
    placed = df.repartition(n, *columns) if n else df.repartition(*columns)
    return placed.sortWithinPartitions(*keys)


def block_bucket_layout(
    df: DataFrame, width: int = BLOCKS_PER_BUCKET, sort_by: Sequence[str] = ("block_number",)
) -> DataFrame:
    """Place rows by block bucket, sorted inside each file."""
    placed = df.withColumn(BUCKET, bucket_of(width))
    return placed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *sort_by)

"""Block ranges: predicates, fork windows and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.schemas import BLOCKS_PER_BUCKET

BUCKET = "block_bucket"


def bucket_of(width: int = BLOCKS_PER_BUCKET, block_number: str = "block_number") -> Column:
    """The partition a block belongs to, computed without floating point."""
    return F.expr(f"`{block_number}` div {int(width)}").cast("long")


def in_range(df: DataFrame, start: int | None, end: int | None, width: int | None = None) -> DataFrame:
    """Rows with start <= block_number <= end; an open end is None.

    ``width`` states that the frame is partitioned into buckets of that many
    blocks. Spark cannot derive a bucket range from a block range, so it is
    spelled out here and prunes partitions.
    """
    if start is not None:
        df = df.where(F.col("block_number") >= start)
        if width:
            df = df.where(F.col(BUCKET) >= start // width)
    if end is not None:
        df = df.where(F.col("block_number") <= end)
        if width:
            df = df.where(F.col(BUCKET) <= end // width)
    return df


def fork_window(
    start: int | None, end: int | None, since: int | None = None, before: int | None = None
) -> tuple[int | None, int | None] | None:
    """The part of a block range on one side of a fork; None when nothing is left."""
    if since is not None:
        start = since if start is None else max(start, since)
    if before is not None:
        end = before - 1 if end is None else min(end, before - 1)
    if start is not None and end is not None and end < start:
        return None
    return start, end

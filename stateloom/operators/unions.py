"""Bag union of any number of frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)

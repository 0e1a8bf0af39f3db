"""Aggregates over access logs. All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slots_set(transition: str = "transition") -> Column:
    return F.count_if(F.col(transition) == 1)


def slots_cleared(transition: str = "transition") -> Column:
    return F.count_if(F.col(transition) == -1)


def has_relationship(kind: str) -> Column:
    return F.bool_or(F.col("relationship") == kind)


def earliest(*position_and_value: str | Column) -> Column:
    """The smallest position with the value found there; equal positions are settled by the value."""
    return F.min(F.struct(*position_and_value))


def latest(*position_and_value: str | Column) -> Column:
    """The largest position with the value found there; equal positions are settled by the value."""
    return F.max(F.struct(*position_and_value))

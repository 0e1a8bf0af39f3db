"""Grouping by wide keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from stateloom.functions.expressions import spread


def per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column, few: bool = False) -> DataFrame:
    """One row per key, with aggregates.

    A number made of the keys leads them. Words of hex share their first letters, so a
    sort by them alone, which an aggregate over text needs and one over numbers falls
    back to when its memory is full, compares whole rows at every step.

    Where a key has a ``few`` rows only, as copies are, rows are shuffled before they are
    combined: an aggregate over text would sort all of them a second time ahead of the
    shuffle, and find next to nothing to combine.
    """
    lead = f"{keys[0]}_spread"
    led = spread(*keys).alias(lead)
    if not aggregates:
        return df.select(led, *keys).distinct().select(*keys)
    if few:
        df, led = df.withColumn(lead, spread(*keys)).repartition(lead), lead
    return df.groupBy(led, *keys).agg(*aggregates).drop(lead)

"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.operators.grouping import per_key


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str | Sequence[str] | None = None,
    values: Sequence[str] | None = None,
    few: bool = False,
) -> DataFrame:
    """Keep the newest row of every key.

    Without a version all copies of a key count as equally new. Ties are settled
    by the remaining columns, so the result does not depend on task order. The
    maximum is combined on the map side: a key holding a large share of all rows
    leaves every task as one row. ``few`` says that no key has many, and spares that.
    """
    versions = [version] if isinstance(version, str) else list(version or [])
    if values is None:
        values = [c for c in df.columns if c not in keys and c not in versions]
    if not values:
        return per_key(df, keys)
    newest = per_key(df, keys, F.max(F.struct(*versions, *values)).alias("newest"), few=few)
    return newest.select(*keys, *(F.col(f"newest.{c}").alias(c) for c in values))


def merge_state(
    state: DataFrame, new: DataFrame, keys: Sequence[str], version: str | Sequence[str]
) -> DataFrame:
    """Merge new rows into one-row-per-key state; the highest version wins."""
    versions = [version] if isinstance(version, str) else list(version)
    merged = state.unionByName(new)
    newest = per_key(
        merged,
        keys,
        F.max(F.struct(*versions, *(c for c in state.columns if c not in keys and c not in versions)))
        .alias("newest"),
    )
    return newest.select(
        *(c if c in keys else F.col(f"newest.{c}").alias(c) for c in state.columns)
    )

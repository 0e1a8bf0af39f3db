"""Idempotent writes of derived tables as Parquet.

Facts (rows per block) are stored by block bucket, and a re-run replaces whole
buckets. State (one row per key) is stored as a merged base plus one folder per
processed range, merged when read and folded into a new base now and then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stateloom.operators.blocks import BUCKET, in_range
from stateloom.operators.dedup import merge_state
from stateloom.operators.layout import (
    ADDRESS_PART,
    block_bucket_layout,
    hash_layout,
    hash_layout_composite,
)
from stateloom.operators.stretches import Interval, Stretch, common, settle, stretches, without
from stateloom.operators.unions import union_all
from stateloom.sources import files


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows of a write inside its own job."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_block_facts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    stored = StructType([*schema, StructField(BUCKET, LongType())])
    if not files.exists(spark, path):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(path)


def write_block_facts(
    df: DataFrame, path: str, start: int, end: int, width: int, sort_by: Sequence[str], spread_out: bool = False
) -> int:
    """Replace the buckets of a block range by the given rows; returns their number.

    The range must cover whole buckets (the last one may end early when nothing
    beyond it was ever written): a replaced bucket holds exactly these rows. Rows that
    are ``spread_out``, as those behind a grouping by several columns, are written by the
    tasks that have them where all are of one bucket: dealing them out by it would bring
    them together again.
    """
    if start % width:
        raise ValueError(f"range {start}-{end} does not begin at a bucket of {width} blocks")
    spark = df.sparkSession
    first, last = start // width, end // width
    present = {int(name.split("=")[1]) for name in files.children(spark, path) if name.startswith(BUCKET)}
    touched = [f"{path}/{BUCKET}={b}" for b in sorted(present) if first <= b <= last]
    before = {bucket: files.children(spark, bucket) for bucket in touched}

    cut = in_range(df, start, end)
    if spread_out and first == last:
        placed = cut.sortWithinPartitions(*sort_by).withColumn(BUCKET, F.lit(first).cast("long"))
    else:
        placed = block_bucket_layout(cut, width, sort_by)
    rows, seen = _counted(placed)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    # A bucket that got no rows is not touched by the write: its old rows go now.
    for bucket, names in before.items():
        if files.children(spark, bucket) == names:
            files.delete(spark, bucket)
    return seen.get["rows"]


def upsert_keyed_state(
    state: DataFrame, new: DataFrame, path: str, keys: Sequence[str], version: str | Sequence[str]
) -> DataFrame:
    """Merge rows into a state and write the result as a new folder."""
    merge_state(state, new, keys, version).write.mode("errorifexists").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


class Attempt(NamedTuple):
    """A complete run over a range of blocks, and where its rows are."""

    lower: int
    upper: int
    run: int
    path: str


class KeyedState:
    """One row per key; the row with the highest (version, run) of those that stand wins.

    ``ranges/since=N/blocks=a-b/run=R`` holds what a run found in a range while
    generation N was in force, and ``generation=N`` a merged snapshot: its ``base``, and
    in ``folded`` the attempts that went into it. Bases and attempts count once Spark's
    commit marker is in them, so an interrupted fold leaves the previous generation in
    force, and a failed repetition of a range leaves the previous attempt. One writer per
    table is assumed.

    For every block the latest run decides. A row stands while its block is still that
    of its own run; others were taken back by a later run, whatever range that ran over.
    Where rows of the base were taken back, their keys are merged anew from the folded
    ranges, until the next fold. The block is the column ``BLOCK``; a state without it is
    merged anew as a whole, and an attempt then counts until all its blocks are taken back.
    """

    RUN = "run_id"
    BLOCK = "block_number"
    FOLDED = "lower long, upper long, run long, path string"

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: str
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.version = list(keys), version
        self.stored = StructType([*schema, StructField(self.RUN, LongType())])

    def _complete(self, path: str) -> bool:
        return files.exists(self.spark, f"{self.path}/{path}/_SUCCESS")

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        names = files.children(self.spark, f"{self.path}/{folder}" if folder else self.path)
        return [int(n.removeprefix(prefix)) for n in names if n.startswith(prefix)]

    def _generation(self) -> int:
        """The newest complete generation, 0 before the first fold."""
        done = [n for n in self._numbers("", "generation=") if self._complete(f"generation={n}/base")]
        return max(done, default=0)

    def _since(self, generation: int) -> list[Attempt]:
        """The complete attempts written while a generation was in force, oldest run first."""
        root, found = f"ranges/since={generation}", []
        for name in files.children(self.spark, f"{self.path}/{root}"):
            if not name.startswith("blocks="):
                continue
            lower, upper = map(int, name.removeprefix("blocks=").split("-"))
            for run in self._numbers(f"{root}/{name}", "run="):
                if self._complete(path := f"{root}/{name}/run={run}"):
                    found.append(Attempt(lower, upper, run, path))
        return sorted(found, key=lambda a: (a.run, a.lower))

    def _folded(self, generation: int) -> list[Attempt]:
        """The attempts in the base of a generation, one small row each."""
        path = f"generation={generation}/folded"
        if not generation or not self._complete(path):
            return []
        rows = self.spark.read.schema(self.FOLDED).parquet(f"{self.path}/{path}").collect()
        return sorted((Attempt(*row) for row in rows), key=lambda a: (a.run, a.lower))

    @staticmethod
    def _decided(attempts: Sequence[Attempt]) -> list[Interval]:
        latest = sorted(attempts, key=lambda a: (a.run, a.lower))
        return settle([(a.lower, a.upper, True, a.run) for a in latest])

    def _standing(self, attempts: Sequence[Attempt]) -> dict[Attempt, list[Stretch]]:
        """The attempts that still decide blocks, with these blocks."""
        by_run: dict[int, list[Stretch]] = {}
        for lower, upper, run in self._decided(attempts):
            by_run.setdefault(run, []).append((lower, upper))
        own = {a: common([(a.lower, a.upper)], by_run.get(a.run, [])) for a in attempts}
        return {a: stretches([(c, d, 0) for c, d in kept]) for a, kept in own.items() if kept}

    def _inside(self, blocks: Sequence[Stretch]) -> Column:
        found = F.lit(False)
        for lower, upper in blocks:
            found = found | F.col(self.BLOCK).between(lower, upper)
        return F.coalesce(found, F.lit(False))

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        where = [f"{self.path}/{p}" for p in paths]
        return self.spark.read.schema(self.stored).parquet(*where).select(*self.stored.fieldNames())

    def _rows(self, standing: Mapping[Attempt, Sequence[Stretch]]) -> DataFrame:
        """The rows of attempts, as far as they stand."""
        cut = {
            a: blocks for a, blocks in standing.items()
            if self.BLOCK in self.schema.fieldNames() and list(blocks) != [(a.lower, a.upper)]
        }
        whole = self._read([a.path for a in standing if a not in cut])
        return union_all(whole, *(self._read([a.path]).where(self._inside(blocks)) for a, blocks in cut.items()))

    def _merged(self, generation: int) -> DataFrame:
        folded, recent = self._folded(generation), self._since(generation)
        standing = self._standing([*folded, *recent])
        new = {a: standing[a] for a in recent if a in standing}
        old = {a: standing[a] for a in folded if a in standing}
        base = self._read([f"generation={generation}/base"] if generation else [])
        taken_back = common(
            stretches(self._decided(folded)), stretches([(c, d, 0) for blocks in new.values() for c, d in blocks])
        )
        if taken_back and self.BLOCK in self.schema.fieldNames():
            gone = self._inside(taken_back)
            keys = base.where(gone).select(*self.keys).distinct()
            second = self._rows(old).join(keys, self.keys, "left_semi")
            base = base.where(~gone).unionByName(second)
        elif taken_back:
            base = self._rows(old)
        return merge_state(base, self._rows(new), self.keys, [self.version, self.RUN])

    def pending(self) -> int:
        """How many ranges were written since the last fold and still stand."""
        generation = self._generation()
        recent = self._since(generation)
        return len(self._standing(recent))

    def remainders(self, start: int, end: int, run_id: int) -> list[Stretch]:
        """What is left of the stored ranges of earlier runs that a range takes back in part."""
        generation = self._generation()
        standing = self._standing([*self._folded(generation), *self._since(generation)])
        left: list[Stretch] = []
        for attempt, blocks in standing.items():
            if attempt.run != run_id and common(blocks, [(start, end)]):
                left += without(blocks, [(start, end)])
        return sorted(left)

    def append(self, df: DataFrame, start: int, end: int, run_id: int) -> int:
        """Store the state of one block range; it takes back what earlier runs said of these blocks."""
        rows, seen = _counted(
            df.select(*self.schema.fieldNames(), F.lit(run_id).cast("long").alias(self.RUN))
        )
        target = f"{self.path}/ranges/since={self._generation()}/blocks={start}-{end}/run={run_id}"
        rows.write.mode("overwrite").parquet(target)
        return seen.get["rows"]

    def read(self) -> DataFrame:
        """Current rows: the base merged with the ranges written since."""
        return self._merged(self._generation()).select(*self.schema.fieldNames())

    def fold(self) -> None:
        """Merge everything into the base of a new generation.

        It costs one pass over the whole state, so it belongs at the end of a run and
        not behind every range. The previous generation stays for those who still read
        it; older ones are removed, and so are attempts that stood in neither.
        """
        if not self.pending():
            return
        last = self._generation()
        now = last + 1
        folded = list(self._standing([*self._folded(last), *self._since(last)]))
        listed = self.spark.createDataFrame(folded, self.FOLDED).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/generation={now}/folded")
        if len(self.keys) > 1:
            placed, parts = hash_layout_composite(self._merged(last), self.keys), ()
        else:
            placed, parts = hash_layout(self._merged(last), sort_by=self.keys), (ADDRESS_PART,)
        placed.write.mode("overwrite").partitionBy(*parts).parquet(f"{self.path}/generation={now}/base")
        needed = {a.path for a in [*folded, *self._folded(last)]}
        for attempt in [*self._folded(last - 1), *self._since(last - 1)] if last else []:
            if attempt.path not in needed:
                files.delete(self.spark, f"{self.path}/{attempt.path}")
        for old in self._numbers("", "generation="):
            if old < last:
                files.delete(self.spark, f"{self.path}/generation={old}")

"""Chunked, resumable builds of derived tables.

The driver handles block bounds and ledger rows only. Every chunk is one Spark
job from scans to a sink that replaces what an earlier attempt left, so a chunk
can be repeated at any time.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.operators.stretches import Interval, Stretch, common, stretches, without
from stateloom.operators.unions import union_all
from stateloom.plans.registry import FACTS, TABLES, TableSpec, in_dependency_order, resolve
from stateloom.schemas import DEFAULT_STEP, MAINNET, Forks
from stateloom.sources import files
from stateloom.sources.inputs import Inputs, last_block
from stateloom.sources.sinks import KeyedState, read_block_facts, write_block_facts
from stateloom.sources.transient import described, is_transient
from stateloom.streaming.ledger import (
    DONE,
    FAILED,
    Ledger,
    range_report,
    run_report,
    standing,
)

log = logging.getLogger(__name__)

MAX_ATTEMPTS = 3
RANGES_BEFORE_FOLD = 64
ROWS_BEFORE_COMPACTION = 200


Covered = Mapping[str, list[Interval]]


def source_coverage(maxima: Mapping[str, DataFrame], known: Iterable[int | None] = ()) -> int | None:
    """The smallest of the last blocks of several tables, None if one of them has no block.

    ``maxima`` are one-row frames, read in one job; ``known`` are last blocks
    known otherwise.
    """
    blocks = list(known)
    if maxima:
        found = union_all(*(m.select(F.col(m.columns[0]).alias("last")) for m in maxima.values())).agg(
            F.min("last"), F.count_if(F.col("last").isNull())
        )
        smallest, empty = found.first()
        blocks.append(None if empty else smallest)
    return None if not blocks or None in blocks else min(blocks)


def chunks(start: int, end: int, step: int) -> list[tuple[int, int]]:
    """Consecutive inclusive ranges of ``step`` blocks; the last one may be shorter."""
    return [(lower, min(lower + step - 1, end)) for lower in range(start, end + 1, step)]


class Warehouse:
    """Derived tables under one folder, the inputs they are built from, and the ledger."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        inputs: Inputs,
        forks: Forks = MAINNET,
        registry: Mapping[str, TableSpec] = TABLES,
        ranges_before_fold: int = RANGES_BEFORE_FOLD,
    ):
        self.spark, self.root, self.inputs, self.forks = spark, root, inputs, forks
        self.registry = dict(registry)
        self.ranges_before_fold = ranges_before_fold
        self.ledger = Ledger(spark, f"{root}/ledger")

    def register(self, spec: TableSpec) -> None:
        self.registry[spec.key] = spec

    def path(self, key: str) -> str:
        return f"{self.root}/{resolve(self.registry, key).key}"

    def _state(self, spec: TableSpec) -> KeyedState:
        return KeyedState(self.spark, self.path(spec.key), spec.schema, spec.keys, spec.version)

    def _stored(self, spec: TableSpec) -> DataFrame:
        if spec.kind == FACTS:
            return read_block_facts(self.spark, self.path(spec.key), spec.schema)
        return self._state(spec).read()

    def read(self, key: str) -> DataFrame:
        """The stored rows of a derived table."""
        spec = resolve(self.registry, key)
        return self._stored(spec).select(*spec.schema.fieldNames())

    def _inputs_of(self, spec: TableSpec) -> Inputs:
        derived = {
            name: self.registry[name]
            for name in spec.inputs
            if name not in self.inputs and name in self.registry
        }
        return self.inputs.with_tables(
            {name: self._stored(source) for name, source in derived.items()},
            {name: source.bucket_width for name, source in derived.items() if source.kind == FACTS},
        )

    def _sources(self, spec: TableSpec) -> tuple[list[str], list[str]]:
        """Stored and derived tables that bound how far a table can be built."""
        stored, derived = [], []
        for name in spec.coverage_inputs:
            if name in self.inputs:
                stored.append(name)
            elif name in self.registry:
                derived.append(name)
            else:
                log.warning("cannot read %s: no such table", name)
        return stored, derived

    def _stored_coverage(self, names: list[str]) -> int | None:
        """The last block that all of some stored tables have; one that cannot be read is skipped."""
        try:
            return source_coverage({name: self.inputs.last_block(name) for name in names})
        except files.SPARK_ERRORS:
            return source_coverage({}, self._readable_maxima(names))

    def _readable_maxima(self, names: Iterable[str]) -> list[int | None]:
        found = []
        for name in names:
            try:
                found.append(self.inputs.last_block(name).first()[0])
            except files.SPARK_ERRORS as error:
                log.warning("cannot read %s: %s", name, error)
        return found

    def available(self, key: str, covered: Covered | None = None) -> list[Stretch]:
        """The blocks for which all sources of a table are there.

        Stored sources reach from block 0 to their last block. A derived source
        counts where the ledger says it was processed, and only there: its own last
        block says little when it is sparse, and nothing about a chunk that failed.
        """
        spec = resolve(self.registry, key)
        stored, derived = self._sources(spec)
        there = None
        if stored or not derived:
            last = self._stored_coverage(stored)
            there = [] if last is None else [(0, last)]
        if derived:
            covered = self.ledger.covered() if covered is None else covered
            for name in derived:
                own = stretches(covered.get(name, []))
                there = own if there is None else common(there, own)
        return there

    def coverage(self, key: str, covered: Covered | None = None) -> int | None:
        """The last block for which all sources of a table are there, None if there is none."""
        there = self.available(key, covered)
        return there[-1][1] if there else None

    def block_range(
        self,
        key: str,
        start: int | None = None,
        end: int | None = None,
        covered: Covered | None = None,
    ) -> Stretch:
        """Where to resume and where to stop; either end can be given.

        Without anything to do the end lies one before the start.
        """
        spec = resolve(self.registry, key)
        if start is None:
            covered = self.ledger.covered() if covered is None else covered
            own = stretches(covered.get(spec.key, []))
            if own:
                start = own[0][1] + 1
            else:
                start = last_block(self._stored(spec), spec.kind == FACTS).first()[0] or 0
        if end is None:
            end = self.coverage(key, covered)
            end = start - 1 if end is None else end
        return start, end

    def _stale(self, spec: TableSpec, derived: list[str], covered: Covered) -> list[Stretch]:
        """Stretches that were done before a derived source was last done there."""
        old = []
        for a, b, run in covered.get(spec.key, []):
            for name in derived:
                newer = [(c, d) for c, d, r in covered.get(name, []) if r > run]
                old += common([(a, b)], newer)
        return stretches([(a, b, 0) for a, b in old])

    def _wanted(
        self, spec: TableSpec, start: int | None, end: int | None, covered: Covered
    ) -> list[Stretch]:
        """The stretches a run has to build: what was asked for, as far as derived sources
        have it, and what became stale where nothing was asked for."""
        _, derived = self._sources(spec)
        first, last = self.block_range(spec.key, start, end, covered)
        asked = [(first, last)] if first <= last else []
        if not derived:
            return asked
        there = self.available(spec.key, covered) if end is None else None
        if there is None:  # an explicit end is not cut to stored sources
            for name in derived:
                own = stretches(covered.get(name, []))
                there = own if there is None else common(there, own)
        if start is not None:
            every = common(asked, there)
        else:
            own = stretches(covered.get(spec.key, []))
            stale = self._stale(spec, derived, covered)
            every = [*without(there, own), *common(stale, there)]
            every = stretches([(a, b, 0) for a, b in every])
            every = every if end is None else common(every, [(0, end)])
        if spec.kind != FACTS:
            return every
        # A bucket is built as a whole: one whose beginning is not there has to wait.
        width, whole = spec.bucket_width, []
        for a, b in every:
            low = a - a % width
            a = a if any(c <= low and a <= d for c, d in there) else low + width
            whole += [(a, b)] if a <= b else []
        return whole

    def _plan(
        self, spec: TableSpec, start: int, end: int, step: int, covered: Covered, run_id: int
    ) -> list[Stretch]:
        """Chunks of a range. Facts are replaced by whole buckets: the first chunk
        begins at a bucket, and the last one reaches as far as its bucket was
        ever filled, so that nothing already stored is lost. A bucket that ends
        early is a chunk of its own, which a later run replaces as a whole.

        A stored range of a state keeps one row of a key only. Where the request
        takes back a part of one, what is left of it is built first, so that rows
        that were second there are found again and none is missing in between."""
        if end < start:
            return []
        if spec.kind != FACTS:
            return [*self._state(spec).remainders(start, end, run_id), *chunks(start, end, step)]
        width = spec.bucket_width
        step = max(width, -(-step // width) * width)
        last_done = max((b for _, b, _ in covered.get(spec.key, [])), default=-1)
        bucket_end = end - end % width + width - 1
        end = min(bucket_end, max(end, last_done))
        planned = chunks(start - start % width, end, step)
        lower, upper = planned[-1]
        cut = upper + 1 - (upper + 1) % width
        if (upper + 1) % width and lower < cut:
            planned[-1:] = [(lower, cut - 1), (cut, upper)]
        return planned

    def _write(self, spec: TableSpec, lower: int, upper: int, run_id: int) -> int:
        window = spec.window(lower, upper, self.forks)
        if window is None:
            return 0
        rows = spec.build(self._inputs_of(spec), *window, self.forks)
        if spec.kind == FACTS:
            return write_block_facts(
                rows, self.path(spec.key), lower, upper, spec.bucket_width, spec.keys, spec.spread_out
            )
        return self._state(spec).append(rows, lower, upper, run_id)

    def _attempt(self, spec: TableSpec, lower: int, upper: int, run_id: int, attempt: int = 1):
        """Process one chunk and record it; returns the error, if any."""
        began, rows, failure = time.monotonic(), 0, None
        try:
            rows = self._write(spec, lower, upper, run_id)
        except Exception as error:
            log.error("%s blocks %d-%d: %s", spec.key, lower, upper, error)
            failure = error
        self.ledger.record(
            table=spec.key,
            lower=lower,
            upper=upper,
            status=FAILED if failure else DONE,
            rows=rows,
            seconds=time.monotonic() - began,
            note=spec.note(lower, upper, self.forks),
            error=described(failure) if failure else None,
            attempt=attempt,
            run_id=run_id,
        )
        return failure

    def _fold(self, spec: TableSpec) -> None:
        if spec.kind != FACTS:
            state = self._state(spec)
            if state.pending() >= self.ranges_before_fold:
                state.fold()

    def run_incremental(
        self, key: str, start: int | None = None, end: int | None = None, step: int = DEFAULT_STEP
    ) -> DataFrame:
        """Build a table over a range in chunks; a failed chunk stops it.

        Where a table reads derived ones, the range is cut to what the ledger has of
        them; without a given start, gaps and chunks that are older than those they
        were built from are built too. Returns the ledger rows of the run.
        """
        spec = resolve(self.registry, key)
        run_id = time.time_ns() // 1000
        self.ledger.compact(ROWS_BEFORE_COMPACTION)
        covered = self.ledger.covered()
        for first, last in self._wanted(spec, start, end, covered):
            for lower, upper in self._plan(spec, first, last, step, covered, run_id):
                failure = self._attempt(spec, lower, upper, run_id)
                if failure:
                    raise failure
                self._fold(spec)
        return self.ledger.entries().where(
            (F.col("table") == spec.key) & (F.col("run_id") == run_id)
        )

    def refresh(
        self,
        keys: Iterable[str] | None = None,
        start: int | None = None,
        end: int | None = None,
        step: int = DEFAULT_STEP,
    ) -> dict[str, Exception | None]:
        """Build several tables, inputs before dependants; returns the error per table.

        Unknown keys are rejected before anything runs. A failed table does not
        stop the others; its dependants get as far as the ledger covers it, and are
        completed by the next refresh behind a retry.
        """
        outcome: dict[str, Exception | None] = {}
        for spec in in_dependency_order(self.registry, self.registry if keys is None else keys):
            try:
                self.run_incremental(spec.key, start, end, step)
                outcome[spec.key] = None
            except Exception as error:
                log.error("%s: %s", spec.key, error)
                outcome[spec.key] = error
        return outcome

    def retry_failed_chunks(self, keys: Iterable[str] | None = None, delay: float = 5.0) -> DataFrame:
        """Repeat chunks whose last attempt failed, and report what became of them.

        A chunk is tried up to three times in all while its error is transient
        (timeouts, lost connections); other errors are final after one more try.
        The failed ranges, one row each, are read by the driver. Tables that read
        a repaired chunk are rebuilt there by the next run without a given start.
        """
        wanted = {resolve(self.registry, key).key for key in keys} if keys is not None else None
        failed = [
            row for row in self.ledger.failed().orderBy("table", "lower").toLocalIterator()
            if wanted is None or row["table"] in wanted
        ]
        run_id = time.time_ns() // 1000
        covered = self.ledger.covered()
        for row in failed:
            spec = resolve(self.registry, row["table"])
            span = row["upper"] - row["lower"] + 1
            for lower, upper in self._plan(spec, row["lower"], row["upper"], span, covered, run_id):
                self._retry(spec, lower, upper, run_id, delay)
            self._fold(spec)
        return retry_summary(self.ledger.latest().where(F.col("run_id") == run_id))

    def _retry(self, spec: TableSpec, lower: int, upper: int, run_id: int, delay: float) -> None:
        for attempt in range(1, MAX_ATTEMPTS + 1):
            failure = self._attempt(spec, lower, upper, run_id, attempt)
            if failure is None or not is_transient(failure):
                return
            if attempt < MAX_ATTEMPTS:
                time.sleep(delay)

    def range_report(self) -> DataFrame:
        return range_report(self.ledger.latest())

    def run_report(self, run_id: int | None = None) -> DataFrame:
        """Totals of each run and table, or of one run."""
        entries = self.ledger.latest_of_run()
        return run_report(entries if run_id is None else entries.where(F.col("run_id") == run_id))

    def table_report(self) -> DataFrame:
        """Totals of each table over all runs; overlapping ranges count once."""
        return run_report(standing(self.ledger.latest()).withColumn("run_id", F.lit(None).cast("long"))).drop("run_id")

    def exists(self, key: str) -> bool:
        return files.exists(self.spark, self.path(key))


def retry_summary(retried: DataFrame) -> DataFrame:
    """Success rate per table of a retry, in percent."""
    good = F.count_if(F.col("status") == DONE)
    return retried.groupBy("table").agg(
        F.count(F.lit(1)).alias("retried"),
        good.alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.round(100.0 * good / F.count(F.lit(1)), 1).alias("success_rate"),
        F.max("attempt").alias("attempts"),
    )

"""States that take rows back: corrected inputs, other chunks, folds in between."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from micro import FORKS, diff, make, rows, tx

from stateloom.plans import tables
from stateloom.plans.registry import TABLES
from stateloom.schemas import ADDRESS_FIRST_ACCESS, ADDRESS_LAST_ACCESS, MAX_BLOCK
from stateloom.sources.sinks import KeyedState
from stateloom.streaming.runner import Warehouse, chunks


def accessed(spark, *blocks):
    return make(spark, transaction=[tx(b, 0) for b in range(10)], balance_diffs=[diff("0xa", b) for b in blocks])


@pytest.mark.parametrize("fold_after", [1, 64])
@pytest.mark.parametrize("again", [[(0, 4), (5, 9)], [(0, 9)], [(5, 9)], [(3, 9)]])
def test_a_corrected_source_takes_rows_back(spark, tmp_path, fold_after, again):
    w = Warehouse(spark, str(tmp_path), accessed(spark, 2, 4, 9), FORKS, TABLES, ranges_before_fold=fold_after)
    w.run_incremental("address_last_access", 0, 9, 10)
    assert rows(w.read("address_last_access"), "block_number") == [(9,)]
    w.inputs = accessed(spark, 2, 4)
    for lower, upper in again:
        w.run_incremental("address_last_access", lower, upper, 10)
    assert rows(w.read("address_last_access"), "block_number") == [(4,)]


def test_what_is_left_of_a_range_is_built_first(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), accessed(spark, 2, 4, 9), FORKS, TABLES)
    w.run_incremental("address_last_access", 0, 9, 10)
    done = w.run_incremental("address_last_access", 3, 6, 2)
    assert sorted((r["lower"], r["upper"]) for r in done.collect()) == [(0, 2), (3, 4), (5, 6), (7, 9)]
    again = w.run_incremental("address_last_access", 3, 6, 2)
    assert sorted((r["lower"], r["upper"]) for r in again.collect()) == [(3, 4), (5, 6)]


def test_a_run_that_breaks_off_keeps_the_state_right(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), accessed(spark, 2, 4, 9), FORKS, TABLES)
    w.run_incremental("address_last_access", 0, 9, 10)
    spec = w.registry["address_last_access"]

    def breaks(inputs, start, end, forks):
        if start == 5:
            raise RuntimeError("broken")
        return spec.build(inputs, start, end, forks)

    w.registry["address_last_access"] = replace(spec, build=breaks)
    with pytest.raises(RuntimeError):
        w.run_incremental("address_last_access", 5, 9, 10)
    assert rows(w.read("address_last_access"), "block_number") == [(9,)]


def test_rows_of_a_run_that_found_nothing_are_gone(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), ADDRESS_LAST_ACCESS, ["address"], "block_number")
    frame = lambda *r: spark.createDataFrame(list(r), ADDRESS_LAST_ACCESS)
    state.append(frame(("0xa", 5, False), ("0xb", 1, False)), 0, 9, 1)
    state.fold()
    state.append(frame(), 0, 9, 2)
    assert rows(state.read()) == []
    state.fold()
    assert rows(state.read()) == [] and state.pending() == 0


def test_attempts_that_stand_nowhere_are_removed(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), ADDRESS_LAST_ACCESS, ["address"], "block_number")
    for run in range(1, 6):
        state.append(spark.createDataFrame([("0xa", run, False)], ADDRESS_LAST_ACCESS), 0, 9, run)
        state.fold()
    left = sorted(str(p.relative_to(tmp_path / "s")) for p in (tmp_path / "s").glob("ranges/*/*/run=*"))
    assert left == ["ranges/since=3/blocks=0-9/run=4", "ranges/since=4/blocks=0-9/run=5"]


@pytest.mark.parametrize("seed", range(4))
def test_any_history_equals_a_build_from_nothing(spark, tmp_path, seed):
    """Random logs, corrections of random stretches, chunk sizes and folds."""
    rng = random.Random(seed)
    first = seed % 2 == 0
    schema = ADDRESS_FIRST_ACCESS if first else ADDRESS_LAST_ACCESS
    version = "version" if first else "block_number"
    state = KeyedState(spark, str(tmp_path / "s"), schema, ["address"], version)
    last, run = 40, 0
    log = {(f"0x{rng.randrange(8)}", rng.randrange(last)) for _ in range(30)}

    def found(lower, upper):
        best = {}
        for key, block in log:
            if lower <= block <= upper:
                best[key] = block if key not in best else (min if first else max)(best[key], block)
        return [(k, b, MAX_BLOCK - b if first else False) for k, b in best.items()]

    def build(lower, upper, step):
        nonlocal run
        run += 1
        for a, b in [*state.remainders(lower, upper, run), *chunks(lower, upper, step)]:
            state.append(spark.createDataFrame(found(a, b), schema), a, b, run)
            if rng.random() < 0.3:
                state.fold()

    build(0, last - 1, rng.choice([7, 13, 40]))
    for _ in range(4):
        lower = rng.randrange(last)
        upper = min(last - 1, lower + rng.randrange(20))
        log = {(k, b) for k, b in log if not lower <= b <= upper or rng.random() < 0.3}
        log |= {(f"0x{rng.randrange(8)}", rng.randint(lower, upper)) for _ in range(rng.randrange(4))}
        build(lower, upper, rng.choice([3, 9, 30]))
        assert rows(state.read()) == sorted(found(0, last - 1))


def test_states_of_two_tables_are_merged_like_their_sources(spark, tmp_path):
    inputs = accessed(spark, 2, 4, 9)
    w = Warehouse(spark, str(tmp_path), inputs, FORKS, TABLES, ranges_before_fold=2)
    for lower, upper, step in ((0, 9, 3), (2, 7, 4), (1, 3, 1)):
        w.run_incremental("address_first_access", lower, upper, step)
    assert rows(w.read("address_first_access")) == rows(tables.address_first_access(inputs, 0, 9))

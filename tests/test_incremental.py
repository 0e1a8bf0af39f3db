"""Ranges, chunked runs, the ledger and retries."""

from __future__ import annotations

from dataclasses import replace

import pytest
from micro import FORKS, ONE, ZERO, contract, destruct, diff, make, read, rows, tx, write
from pyspark.sql import functions as F

from stateloom.operators.stretches import common, settle, stretches, without
from stateloom.plans import tables
from stateloom.plans.registry import TABLES, custom_table, fork_note, in_dependency_order, resolve
from stateloom.schemas import BLOCK_SLOTS_STAT
from stateloom.sources.inputs import Inputs
from stateloom.sources.transient import is_transient
from stateloom.streaming.runner import Warehouse, chunks


def life(spark) -> Inputs:
    """Blocks 1 to 29 of a small chain, forks at 10 and 15."""
    blocks = range(1, 30)
    return make(
        spark,
        transaction=[tx(b, n, success=b % 7 != 0) for b in blocks for n in (0, 1)],
        balance_diffs=[diff(f"0xA{b % 4}", b, b % 2) for b in blocks],
        nonce_diffs=[diff(f"0xa{b % 5}", b) for b in blocks],
        storage_diffs=[
            write(f"0xa{b % 3}", f"s{b % 2}", b, 1, old=ZERO if b % 3 else ONE, new=ONE if b % 4 else ZERO)
            for b in blocks
        ],
        storage_reads=[read(f"0xA{b % 4}", f"s{b % 2}", b, value=f"v{b}") for b in blocks],
        balance_reads=[diff(f"0xa{b % 6}", b) for b in blocks],
        nonce_reads=[diff(f"0xa{b % 7}", b, 1) for b in blocks],
        contracts=[contract(f"0xa{b % 5}", b) for b in blocks],
        traces=[destruct(f"0xa{b % 5}", b, to=f"0xa{b % 3}", value=str(b % 2)) for b in blocks],
    )


CHAIN_FORKS = replace(FORKS, state_clearing=10, same_tx_destruct=15)


def warehouse(spark, path, inputs, width, **options):
    registry = {k: replace(s, bucket_width=width) for k, s in TABLES.items()}
    return Warehouse(spark, str(path), inputs, CHAIN_FORKS, registry, **options)


def whole(inputs, key):
    if key == "accounts_alive":
        inputs = inputs.with_tables(
            {k: whole(inputs, k) for k in ("address_diffs", "pre_fork_destructs", "post_fork_destructs")}
        )
    return TABLES[key].build(inputs, None, None, CHAIN_FORKS)


KEYS = ["address_diffs", "pre_fork_destructs", "post_fork_destructs", "accounts_alive", "slot_first_access_ordered"]


@pytest.mark.parametrize("step", [7, 100])
def test_chunk_size_does_not_matter(spark, tmp_path, step):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, step, ranges_before_fold=2)
    assert not any(w.refresh(KEYS, step=step).values())
    for key in KEYS:
        assert rows(w.read(key)) == rows(whole(inputs, key)), key


def test_single_block_chunks(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 1)
    w.run_incremental("block_slots_stat", 1, 6, 1)
    assert rows(w.read("block_slots_stat")) == rows(tables.block_slots_stat(inputs, 1, 6))


def test_resume_adds_nothing_twice(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 10)
    w.run_incremental("address_diffs", 0, 13, 10)
    assert w.block_range("address_diffs") == (14, 29)
    w.run_incremental("address_diffs", step=10)
    w.run_incremental("address_diffs", 13, 13, 10)
    assert rows(w.read("address_diffs")) == rows(whole(inputs, "address_diffs"))
    assert w.block_range("address_diffs") == (30, 29)
    assert w.run_incremental("address_diffs").count() == 0


def test_a_range_may_be_one_block(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 1)
    w.run_incremental("address_reads", 5, 5, 1)
    assert rows(w.read("address_reads")) == rows(tables.address_reads(inputs, 5, 5))


def test_resume_without_a_ledger(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 10)
    w.run_incremental("block_slots_stat", 0, 12, 10)
    w.ledger.path = str(tmp_path / "lost")
    last = w.read("block_slots_stat").agg(F.max("block_number")).first()[0]
    assert w.block_range("block_slots_stat") == (last, 29)
    w.run_incremental("block_slots_stat", step=10)
    assert rows(w.read("block_slots_stat")) == rows(whole(inputs, "block_slots_stat"))


def test_coverage(spark, tmp_path, caplog):
    inputs = make(spark, transaction=[tx(9, 0)], balance_reads=[diff("0xa", 7)], nonce_reads=[diff("0xa", 8)])
    w = warehouse(spark, tmp_path, inputs, 10)
    assert w.coverage("address_reads") is None
    assert w.block_range("address_reads") == (0, -1)
    assert w.run_incremental("address_reads").count() == 0
    missing = Inputs({n: df for n, df in inputs.tables.items() if n != "storage_reads"})
    w = warehouse(spark, tmp_path, missing, 10)
    assert w.coverage("address_reads") == 7
    assert "storage_reads" in caplog.text
    assert warehouse(spark, tmp_path, Inputs({}), 10).coverage("address_reads") is None


def test_coverage_skips_a_source_that_breaks(spark, tmp_path, caplog):
    inputs = make(spark, transaction=[tx(9, 0)], balance_reads=[diff("0xa", 7)], nonce_reads=[diff("0xa", 8)])
    path = tmp_path / "reads"
    inputs.table("storage_reads").write.parquet(str(path))
    broken = spark.read.parquet(str(path))
    for part in path.glob("part-*"):
        part.write_bytes(b"broken")
    w = warehouse(spark, tmp_path, inputs.with_tables({"storage_reads": broken}), 10)
    assert w.coverage("address_reads") == 7
    assert "storage_reads" in caplog.text


def test_sparse_tables_are_covered_by_the_ledger(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 10)
    w.refresh(["address_diffs", "pre_fork_destructs", "post_fork_destructs"], step=10)
    assert w.read("pre_fork_destructs").agg(F.max("block_number")).first()[0] < 15
    assert w.coverage("accounts_alive") == 29


def counted(fails_at=(), error="broken"):
    def build(inputs, start, end):
        if start in fails_at:
            fails_at.remove(start)
            raise RuntimeError(error)
        reads = inputs["storage_reads"].groupBy("block_number").agg(F.count("*").alias("slots_set"))
        zero = F.lit(0).cast("long")
        return reads.select(
            "block_number", zero.alias("slots_cleared"), "slots_set",
            zero.alias("net_slots"), zero.alias("net_slots_bytes"),
        )

    return custom_table(
        "reads", ("storage_reads",), BLOCK_SLOTS_STAT, build, ("block_number",), bucket_width=10,
        note=lambda start, end, forks: f"from {start}",
    )


def test_custom_table(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted())
    w.run_incremental("reads", step=10)
    assert rows(w.read("reads"), "block_number", "slots_set") == [(b, 1) for b in range(1, 30)]
    assert rows(w.range_report(), "lower", "upper", "blocks", "status", "rows", "note", "progress") == [
        (0, 9, 10, "done", 9, "from 0", 33.33),
        (10, 19, 10, "done", 10, "from 10", 66.67),
        (20, 29, 10, "done", 10, "from 20", 100.0),
    ]
    assert rows(w.run_report(), "table", "ranges", "failed", "blocks", "rows") == [("reads", 3, 0, 30, 29)]


def test_reports_count_overlaps_once(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted())
    w.run_incremental("reads", 0, 14, 10)
    w.run_incremental("reads", step=10)
    assert rows(w.table_report(), "table", "blocks", "rows") == [("reads", 30, 29)]
    assert sum(r["blocks"] for r in w.range_report().collect()) == 30
    assert sorted(rows(w.run_report(), "blocks", "rows")) == [(15, 14), (20, 20)]
    assert w.read("reads").count() == 29


def failing(w, key, at):
    """Let the plan of a table fail once for the chunk that begins at a block."""
    spec, left = w.registry[key], [at]

    def build(inputs, start, end, forks):
        if start in left:
            left.remove(start)
            raise RuntimeError("broken")
        return spec.build(inputs, start, end, forks)

    w.registry[key] = replace(spec, build=build)


LIFE = ["address_diffs", "pre_fork_destructs", "post_fork_destructs", "accounts_alive"]


@pytest.mark.parametrize("at", [0, 10])
@pytest.mark.parametrize("given", [(), (0, 29)])
def test_a_failed_input_leaves_no_wrong_dependant(spark, tmp_path, at, given):
    inputs = life(spark)
    inputs = inputs.with_tables(
        {"balance_diffs": inputs.table("balance_diffs").union(make(spark, balance_diffs=[diff("0xzero", 0)]).table("balance_diffs")),
         "transaction": inputs.table("transaction").union(make(spark, transaction=[tx(0, 0), tx(0, 1)]).table("transaction"))}
    )
    w = warehouse(spark, tmp_path, inputs, 10)
    failing(w, "address_diffs", at)
    outcome = w.refresh(LIFE, *given, step=10)
    assert outcome["address_diffs"] is not None
    done = stretches(w.ledger.covered().get("accounts_alive", []))
    assert done == ([(0, at - 1)] if at else [])
    w.retry_failed_chunks(delay=0)
    assert not any(w.refresh(LIFE, step=10).values())
    assert rows(w.read("accounts_alive")) == rows(whole(inputs, "accounts_alive"))
    assert "0xzero" in {r["address"] for r in w.read("accounts_alive").collect()}


def test_a_rebuilt_input_makes_its_dependants_stale(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.refresh(LIFE, step=10)
    assert w.run_incremental("accounts_alive", step=10).count() == 0
    w.run_incremental("address_diffs", 10, 19, 10)
    again = w.run_incremental("accounts_alive", step=10)
    assert rows(again, "lower", "upper") == [(10, 19)]


def test_only_what_is_there_is_built(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    for key in LIFE[:3]:
        w.run_incremental(key, 10, 19, 10)
    assert w.available("accounts_alive") == [(10, 19)]
    w.run_incremental("accounts_alive", 0, 29, 10)
    assert stretches(w.ledger.covered()["accounts_alive"]) == [(10, 19)]


def test_a_failed_repetition_keeps_the_state(spark, tmp_path):
    inputs = life(spark)
    w = warehouse(spark, tmp_path, inputs, 30)
    w.run_incremental("address_last_access", 0, 29, 30)
    before = rows(w.read("address_last_access"))
    spec = w.registry["address_last_access"]
    broken = F.when(F.col("block_number") > 20, F.raise_error(F.lit("broken"))).otherwise(F.col("block_number")).cast("long")
    w.registry["address_last_access"] = replace(spec, build=lambda *a: spec.build(*a).withColumn("block_number", broken))
    with pytest.raises(Exception, match="broken"):
        w.run_incremental("address_last_access", 0, 29, 30)
    assert rows(w.read("address_last_access")) == before
    assert w.ledger.covered()["address_last_access"] == []
    w.registry["address_last_access"] = spec
    w.retry_failed_chunks(delay=0)
    assert rows(w.read("address_last_access")) == before


def test_old_generations_are_removed(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 5, ranges_before_fold=1)
    w.run_incremental("address_last_access", 0, 24, 5)
    assert sorted(p.name for p in (tmp_path / "address_last_access").iterdir()) == ["generation=4", "generation=5", "ranges"]
    assert rows(w.read("address_last_access")) == rows(tables.address_last_access(w.inputs, 0, 24))


def test_settled_stretches():
    assert settle([(0, 9, True, 1), (5, 14, False, 2)]) == [(0, 4, 1)]
    assert settle([(0, 29, True, 1), (10, 19, True, 2)]) == [(0, 9, 1), (10, 19, 2), (20, 29, 1)]
    assert stretches([(0, 9, 1), (10, 19, 2), (30, 39, 1)]) == [(0, 19), (30, 39)]
    assert common([(0, 9), (20, 29)], [(5, 24)]) == [(5, 9), (20, 24)]
    assert without([(0, 29)], [(10, 19), (25, 40)]) == [(0, 9), (20, 24)]


def test_failure_stops_the_table_and_retry_completes_it(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted(fails_at=[10], error="java.net.SocketException: Connection reset"))
    with pytest.raises(RuntimeError):
        w.run_incremental("reads", step=10)
    assert rows(w.ledger.failed(transient_only=True), "lower", "upper") == [(10, 19)]
    assert w.block_range("reads") == (10, 29)
    assert rows(w.retry_failed_chunks(delay=0)) == [("reads", 1, 1, 0, 100.0, 1)]
    assert w.ledger.failed().count() == 0
    assert w.block_range("reads") == (20, 29)
    w.run_incremental("reads", step=10)
    assert w.read("reads").count() == 29


def test_a_later_run_makes_up_for_a_failure(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted(fails_at=[0]))
    with pytest.raises(RuntimeError):
        w.run_incremental("reads", 0, 5, 10)
    assert rows(w.ledger.failed(), "lower", "upper") == [(0, 5)]
    w.run_incremental("reads", 0, 29, 30)
    assert w.retry_failed_chunks(delay=0).count() == 0
    assert w.read("reads").count() == 29


def test_transient_errors_get_three_tries_and_others_one(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted(fails_at=[0] * 5, error="java.net.SocketTimeoutException: Read timed out"))
    with pytest.raises(RuntimeError):
        w.run_incremental("reads", step=10)
    assert rows(w.retry_failed_chunks(["reads"], delay=0)) == [("reads", 1, 0, 1, 0.0, 3)]
    assert rows(w.retry_failed_chunks(["reads"], delay=0)) == [("reads", 1, 1, 0, 100.0, 2)]
    w.register(counted(fails_at=[10] * 5, error="no such column"))
    with pytest.raises(RuntimeError):
        w.run_incremental("reads", step=10)
    assert rows(w.retry_failed_chunks(["reads"], delay=0)) == [("reads", 1, 0, 1, 0.0, 1)]
    assert is_transient(TimeoutError("x")) and not is_transient(RuntimeError("x"))
    assert is_transient("org.apache.spark.shuffle.FetchFailedException: gone")
    assert not is_transient("[TABLE_OR_VIEW_NOT_FOUND] no connection table")


def test_one_failure_does_not_stop_the_rest(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 100)
    w.register(counted(fails_at=[0]))
    outcome = w.refresh(["reads", "block_slots_stat"], step=100)
    assert outcome["reads"] is not None and outcome["block_slots_stat"] is None
    assert w.read("block_slots_stat").count() > 0


def test_unknown_keys_are_rejected_first(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    with pytest.raises(KeyError, match="unknown table"):
        w.refresh(["address_diffs", "no_such_table"])
    assert not w.exists("address_diffs")
    with pytest.raises(KeyError):
        resolve(TABLES, "no_such_table")


def test_inputs_come_before_dependants():
    keys = [s.key for s in in_dependency_order(TABLES, reversed(TABLES))]
    assert sorted(keys) == sorted(TABLES)
    for spec in TABLES.values():
        for name in spec.inputs:
            if name in TABLES:
                assert keys.index(name) < keys.index(spec.key)
    assert resolve(TABLES, "post_6780_accounts_destructs").key == "post_fork_destructs"


def test_chunks():
    assert chunks(0, 25, 10) == [(0, 9), (10, 19), (20, 25)]
    assert chunks(3, 3, 10) == [(3, 3)]
    assert chunks(4, 3, 10) == []


def test_fork_notes():
    assert fork_note(0, 49, FORKS) == "pre-EIP-6780"
    assert fork_note(50, 60, FORKS) == "post-EIP-6780"
    assert fork_note(0, 50, FORKS) == "spans EIP-6780"


def test_the_ledger_is_compacted(spark, tmp_path):
    w = warehouse(spark, tmp_path, life(spark), 10)
    w.register(counted())
    w.run_incremental("reads", 0, 19, 10)
    before = rows(w.ledger.entries())
    w.ledger.compact(3)
    assert not (tmp_path / "ledger" / "base=1").exists()
    w.ledger.compact(2)
    assert sorted(p.name for p in (tmp_path / "ledger").iterdir()) == ["base=1"]
    assert rows(w.ledger.entries()) == before
    w.run_incremental("reads", step=10)
    assert stretches(w.ledger.covered()["reads"]) == [(0, 29)]
    assert len(list((tmp_path / "ledger" / "base=1").glob("part-*"))) == 1

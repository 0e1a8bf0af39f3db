"""Facts of one bucket that their plan has spread out already."""

from __future__ import annotations

import os

import pytest
from micro import rows

from stateloom.plans.registry import TABLES
from stateloom.schemas import ADDRESS_DIFFS
from stateloom.sources.sinks import read_block_facts, write_block_facts

COLUMNS = ("address", "block_number", "tx_count", "last_tx_index")


def facts(spark, n):
    """n rows in eight tasks, none in the order of the keys."""
    return spark.range(n, numPartitions=8).selectExpr(
        "concat('0x', id * 7 % 13) AS address", "id % 20 AS block_number", "id AS tx_count", "id AS last_tx_index"
    )


def written(path):
    return {name: len([f for f in os.listdir(f"{path}/{name}") if f.endswith(".parquet")]) for name in os.listdir(path) if "=" in name}


@pytest.mark.parametrize("n", [0, 1, 400])
def test_one_bucket_is_written_by_the_tasks_that_have_its_rows(spark, tmp_path, n):
    path, own = str(tmp_path / "facts"), facts(spark, n)
    for _ in range(2):
        assert write_block_facts(own, path, 40, 59, 20, ["address", "block_number"], spread_out=True) == 0
        assert write_block_facts(own, path, 0, 19, 20, ["address", "block_number"], spread_out=True) == n
    assert rows(read_block_facts(spark, path, ADDRESS_DIFFS), *COLUMNS) == rows(own, *COLUMNS)
    if n == 400:
        assert written(path) == {"block_bucket=0": 8}
        for name in os.listdir(f"{path}/block_bucket=0"):
            if name.endswith(".parquet"):
                keys = [(r.address, r.block_number) for r in spark.read.parquet(f"{path}/block_bucket=0/{name}").collect()]
                assert keys == sorted(keys) and len(keys) == 50


def test_several_buckets_are_dealt_out(spark, tmp_path):
    path, own = str(tmp_path / "facts"), facts(spark, 400)
    assert write_block_facts(own, path, 0, 19, 5, ["address", "block_number"], spread_out=True) == 400
    assert written(path) == {f"block_bucket={b}": 1 for b in range(4)}
    assert rows(read_block_facts(spark, path, ADDRESS_DIFFS), *COLUMNS) == rows(own, *COLUMNS)


def test_tables_per_address_and_block_are_spread_out():
    assert {key for key, spec in TABLES.items() if spec.spread_out} == {"address_diffs", "address_reads", "address_slots_stat_per_block"}

"""Groupings and joins by words that begin alike."""

from __future__ import annotations

import re

from micro import diff, make, rows, tx, write
from pyspark.sql import functions as F
from test_plans import no_broadcast, plan

from stateloom.functions.expressions import digest, transaction_id
from stateloom.operators.dedup import latest_per_key
from stateloom.plans import events as ev
from stateloom.plans import tables


def micro_inputs(spark):
    return make(
        spark,
        versions={"storage_diffs": "v"},
        transaction=[tx(5, 0), tx(6, 0, success=False), tx(7, 0)],
        balance_diffs=[diff("0xa", 5), diff("0xA", 5), diff("0xb", 6), diff("0xa", 7, hash="0xT7.0")],
        storage_diffs=[
            write("0xa", "s", 5, v=1), write("0xa", "s", 5, v=2, new="0x2"), write("0xa", "s", 6, v=1),
            write("0xa", None, 7, v=1), write("0xa", "s", 7, v=1) | {"transaction_hash": None},
        ],
    )


def test_sorts_by_words_are_led_by_a_number(spark):
    i = micro_inputs(spark)
    with no_broadcast(spark):
        for df in (
            tables.slot_changes(i), tables.address_diffs(i), tables.address_first_access(i),
            ev.successful_storage_accesses(i, None, None), latest_per_key(i.table("storage_diffs"), ["address", "slot"], "v"),
        ):
            text = plan(df)
            for first in re.findall(r"(?:Sort|HashAggregate\(keys=) ?\[([^,\]]*)", text):
                assert not re.match(r"(address|slot|slot_key|transaction_hash|successful|lower\(.*)#", first), first


def test_merges_hold_numbers_for_the_words_of_transactions(spark):
    i = micro_inputs(spark)
    with no_broadcast(spark):
        for df in (tables.slot_changes(i), tables.address_diffs(i), tables.address_first_access(i)):
            for keys in re.findall(r"hashpartitioning\((.*?), \d+\)", plan(df)):
                assert "transaction_hash" not in keys and "slot#" not in keys


def test_copies_of_failed_transactions_leave_before_the_merge(spark):
    with no_broadcast(spark):
        text = plan(ev.successful_storage_accesses(micro_inputs(spark), None, None))
    assert text.index("SortAggregate") < text.index("SortMergeJoin")


def test_missing_hashes_and_slots(spark):
    i = micro_inputs(spark)
    for df in (tables.address_slots_stat_per_block(i),):
        assert rows(df) == [("0xa", 5, 0, 1, 1, 64), ("0xa", 7, 0, 1, 1, 64)]
    assert rows(tables.address_diffs(i)) == [("0xa", 5, 1, 0), ("0xa", 7, 1, 0)]
    got = rows(ev.successful_storage_accesses(i, None, None), "block_number", "value")
    assert [r[0] for r in got] == [5, 7] and got[0][1] == "0x2"


def test_digests_tell_nulls_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), (None, None), ("x", "x")], "a string, b string")
    for part in range(2):
        assert df.select(digest("a", "b")[part].alias("d")).distinct().count() == 4
    ids = spark.createDataFrame([("0xAb",), ("0xaB",), (None,)], "transaction_hash string").select(*transaction_id())
    assert ids.distinct().count() == 2 and ids.where(F.col("tx_1").isNull() & F.col("tx_2").isNull()).count() == 1

"""What Spark makes of the plans, and properties of their results."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from micro import rows
from pyspark.sql import functions as F

from stateloom.operators.blocks import BUCKET, fork_window
from stateloom.operators.dedup import latest_per_key
from stateloom.operators.layout import block_bucket_layout, hash_layout
from stateloom.plans import tables
from stateloom.plans.registry import TABLES
from stateloom.sources.inputs import Inputs
from stateloom.sources.sinks import read_block_facts, write_block_facts
from workload import adapter

SF_DIR = "/root/testdata/sf0.001"
FORKS = adapter.FORKS
BASE = [k for k in TABLES if k not in ("accounts_alive", "block_slots_stat_rollup")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The canonical tables as Parquet, the way a user has them."""
    root = str(tmp_path_factory.mktemp("canonical"))
    for name, df in adapter.inputs(spark, SF_DIR).tables.items():
        df.write.parquet(f"{root}/{name}")
    return Inputs.from_parquet(spark, root, versions=adapter.VERSIONS)


@contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(spark):
    return conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    )


def build(key, inputs, start=None, end=None):
    if key == "accounts_alive":
        inputs = inputs.with_tables(
            {k: build(k, inputs, start, end) for k in ("address_diffs", "pre_fork_destructs", "post_fork_destructs")}
        )
    if key == "block_slots_stat_rollup":
        inputs = inputs.with_tables({"address_slots_stat_per_block": build("address_slots_stat_per_block", inputs, start, end)})
    return TABLES[key].build(inputs, start, end, FORKS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", TABLES)
def test_every_scan_is_bounded_and_pruned(stored, key):
    df = build(key, stored, 10, 120)
    text = df._jdf.queryExecution().toString()
    physical = text.split("== Physical Plan ==")[1]
    scans = re.findall(r"FileScan parquet.*?PushedFilters: (\[.*?\]), ReadSchema", physical)
    assert scans
    for filters in scans:
        assert "GreaterThanOrEqual(block_number," in filters, filters
        assert "LessThanOrEqual(block_number," in filters, filters
    assert "PythonUDF" not in physical and "ArrowEvalPython" not in physical
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical


@pytest.mark.parametrize("key", BASE)
def test_small_transactions_are_broadcast(stored, key):
    assert "BroadcastHashJoin" in plan(build(key, stored))


@pytest.mark.parametrize("key", TABLES)
def test_shuffle_joins_give_the_same(spark, stored, key):
    want = rows(build(key, stored))
    with no_broadcast(spark):
        df = build(key, stored)
        if key in BASE:
            assert "SortMergeJoin" in plan(df) and "BroadcastHashJoin" not in plan(df)
        assert rows(df) == want
    assert want


def test_the_semi_join_moves_below_the_merge_only_when_broadcast(spark, stored):
    small = plan(tables.slot_changes(stored))
    assert small.index("BroadcastHashJoin") > small.index("Exchange hashpartitioning(address")
    with no_broadcast(spark):
        large = plan(tables.slot_changes(stored))
        assert large.index("SortMergeJoin") < large.index("Exchange hashpartitioning(address")


def test_numeric_merges_are_hash_aggregates(stored):
    for key in ("address_slots_stat_per_block", "block_slots_stat", "accounts_alive", "address_diffs"):
        assert "SortAggregate" not in plan(build(key, stored)), key


@pytest.mark.parametrize("key", TABLES)
def test_copies_of_rows_change_nothing(stored, key):
    doubled = Inputs({n: df.unionByName(df) for n, df in stored.tables.items()}, stored.versions)
    assert rows(build(key, doubled)) == rows(build(key, stored))


def test_first_is_not_after_last(stored):
    pairs = [
        ("address_first_access", "address_last_access", ["address"]),
        ("slot_first_access_ordered", "slot_last_access_ordered", ["address", "slot_key"]),
        ("slot_first_access_success", "slot_last_access_success", ["address", "slot_key"]),
    ]
    for first, last, keys in pairs:
        a, b = build(first, stored), build(last, stored)
        both = a.select(*keys, F.col("block_number").alias("first")).join(
            b.select(*keys, F.col("block_number").alias("last")), keys, "full"
        )
        assert both.where("first IS NULL OR last IS NULL OR first > last").count() == 0
        assert both.count() == a.count()


@pytest.mark.parametrize("key", TABLES)
def test_output_schema(stored, key):
    df = build(key, stored)
    want = [(f.name, f.dataType) for f in TABLES[key].schema]
    assert [(f.name, f.dataType) for f in df.schema] == want


def test_hot_keys_give_right_results(spark):
    """A third of all rows in one address, one transaction and one slot."""
    from micro import make

    n = 3000
    hot = "CASE WHEN id % 3 = 0 THEN {0} ELSE {1} END"
    base = spark.range(n).selectExpr(
        "id",
        "concat('0x', " + hot.format("'HOT'", "cast(id % 40 AS string)") + ") AS address",
        "cast(" + hot.format("7", "id % 50") + " AS bigint) AS block_number",
    ).withColumn("transaction_hash", F.concat(F.lit("0xT"), "block_number"))
    i = make(spark).with_tables(
        {
            "transaction": spark.range(50).selectExpr(
                "concat('0xt', id) AS transaction_hash", "id % 5 AS transaction_index",
                "id AS block_number", "id % 4 != 0 AS success",
            ),
            "balance_diffs": base.drop("id"),
            "storage_reads": base.selectExpr(
                "address AS contract_address", "'s' AS slot", "block_number", "transaction_hash",
                "cast(id AS string) AS value",
            ),
        }
    )
    diffs, first = {}, {}
    for r in base.collect():
        if r.block_number % 4:
            a = r.address.lower()
            diffs.setdefault((a, r.block_number), set()).add(r.transaction_hash.lower())
            at = (r.block_number, str(r.id))
            first[a] = min(first.get(a, at), at)
    for setting in (-1, 10_000_000):
        with conf(spark, spark__sql__autoBroadcastJoinThreshold=setting):
            assert rows(tables.address_diffs(i)) == sorted(
                (a, b, len(h), b % 5) for (a, b), h in diffs.items()
            )
            assert rows(tables.slot_first_access_success(i), "address", "block_number", "value") == sorted(
                (a, b, v) for a, (b, v) in first.items()
            )
            assert rows(tables.address_first_access(i), "address", "block_number") == sorted(
                (a, b) for a, (b, _) in first.items()
            )


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("j", 1, None)], "k string, v int, x string")
    for partitions in (1, 4):
        got = latest_per_key(df.repartition(partitions), ["k"], "v")
        assert sorted(got.collect()) == [("j", None), ("k", "c")]
    assert sorted(latest_per_key(df.drop("v", "x"), ["k"]).collect()) == [("j",), ("k",)]


def test_a_block_range_prunes_buckets(spark, tmp_path, stored):
    path = str(tmp_path / "facts")
    write_block_facts(tables.block_slots_stat(stored), path, 0, 149, 50, ["block_number"])
    facts = read_block_facts(spark, path, TABLES["block_slots_stat"].schema)
    inputs = Inputs({"facts": facts}, bucket_widths={"facts": 50})
    df = inputs.scan("facts", 60, 90)
    assert rows(df, "block_number") == [(b,) for b in range(60, 91)]
    scan = plan(df)
    assert f"{BUCKET}" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert inputs.max_block("facts").first()[0] == 149


def test_block_range_is_inclusive(stored):
    got = rows(stored.scan("transaction", 3, 5, "block_number").distinct())
    assert got == [(3,), (4,), (5,)]


def test_fork_window():
    assert fork_window(0, 100, before=50) == (0, 49)
    assert fork_window(0, 100, since=50) == (50, 100)
    assert fork_window(50, 100, before=50) is None
    assert fork_window(0, 49, since=50) is None
    assert fork_window(None, None, before=50) == (None, 49)
    assert fork_window(None, None, since=50) == (50, None)


def test_tables_from_a_catalog(spark, stored):
    stored.table("transaction").createOrReplaceTempView("chain_transaction")
    inputs = Inputs.from_catalog(spark, "chain_", ["transaction"])
    assert inputs.max_block("transaction").first()[0] == 149
    with pytest.raises(KeyError):
        inputs.table("no_such_table")


@pytest.mark.parametrize("placed, column", [(hash_layout, "address_part"), (block_bucket_layout, BUCKET)])
def test_writes_are_rebalanced(stored, placed, column):
    text = plan(placed(build("address_reads", stored)))
    assert re.search(rf"hashpartitioning\({column}#.*REBALANCE_PARTITIONS_BY_COL", text)


@pytest.mark.parametrize("versions", [None, {"transaction": "v"}])
def test_a_hot_transaction_is_split_in_shuffle_joins(spark, versions):
    """Adaptive execution may cut the partition of a hot hash: no step behind the join needs it whole."""
    from micro import make

    n = 40_000
    hot = "concat('0xt', CASE WHEN id % 3 = 0 THEN 7 ELSE id % 500 END) AS transaction_hash"
    i = make(spark, versions=versions).with_tables(
        {
            "transaction": spark.range(500).selectExpr(
                "concat('0xt', id) AS transaction_hash", "id AS transaction_index",
                "0L AS block_number", "true AS success", "1L AS v",
            ),
            "balance_diffs": spark.range(n, numPartitions=8).selectExpr(
                "concat('0x', id) AS address", "0L AS block_number", hot
            ),
            "storage_reads": spark.range(n, numPartitions=8).selectExpr(
                "concat('0x', id) AS contract_address", "'s' AS slot", "0L AS block_number", hot,
                "cast(id AS string) AS value",
            ),
        }
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 20_000,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 20_000,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": 20_000,
        "spark.sql.shuffle.partitions": 16,
    }
    with conf(spark, **{k.replace(".", "__"): v for k, v in settings.items()}):
        for key in ("address_diffs", "address_first_access", "slot_first_access_success"):
            df = TABLES[key].build(i, None, None, FORKS)
            assert len(df.collect()) == n, key
            assert "skew=true" in plan(df), key

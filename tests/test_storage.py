"""Sinks, layouts and the bulk loader."""

from __future__ import annotations

import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from micro import rows

from stateloom.operators.layout import ADDRESS_PART, hash_layout, hash_layout_composite
from stateloom.schemas import ADDRESS_FIRST_ACCESS, ADDRESS_LAST_ACCESS, BLOCK_SLOTS_STAT
from stateloom.sources import bulk_load, sinks
from stateloom.sources.files import shared_dir


def facts(spark, *blocks, slots_set=1):
    return spark.createDataFrame(
        [(b, 0, slots_set, slots_set, 64 * slots_set) for b in blocks], BLOCK_SLOTS_STAT
    )


def stored(spark, path):
    df = sinks.read_block_facts(spark, path, BLOCK_SLOTS_STAT)
    return rows(df, "block_number", "slots_set")


def test_buckets_are_replaced(spark, tmp_path):
    path = str(tmp_path / "facts")
    write = lambda df, a, b: sinks.write_block_facts(df, path, a, b, 10, ["block_number"])
    assert stored(spark, path) == []
    assert write(facts(spark, 1, 9, 10, 25), 0, 29) == 4
    assert write(facts(spark, 1, 9, 10, 25), 0, 29) == 4
    assert stored(spark, path) == [(1, 1), (9, 1), (10, 1), (25, 1)]
    assert write(facts(spark, 3, slots_set=5), 0, 9) == 1
    assert stored(spark, path) == [(3, 5), (10, 1), (25, 1)]


def test_bucket_without_rows_is_cleared(spark, tmp_path):
    path = str(tmp_path / "facts")
    sinks.write_block_facts(facts(spark, 1, 11, 21), path, 0, 29, 10, ["block_number"])
    sinks.write_block_facts(facts(spark, 1, 21), path, 0, 29, 10, ["block_number"])
    assert stored(spark, path) == [(1, 1), (21, 1)]
    assert sinks.write_block_facts(facts(spark).where("false"), path, 20, 29, 10, ["block_number"]) == 0
    assert stored(spark, path) == [(1, 1)]


def test_rows_outside_the_range_are_not_written(spark, tmp_path):
    path = str(tmp_path / "facts")
    sinks.write_block_facts(facts(spark, 1, 15), path, 0, 9, 10, ["block_number"])
    assert stored(spark, path) == [(1, 1)]
    with pytest.raises(ValueError, match="bucket"):
        sinks.write_block_facts(facts(spark, 5), path, 5, 9, 10, ["block_number"])


def first(spark, *pairs):
    return spark.createDataFrame([(a, b, 4294967295 - b) for a, b in pairs], ADDRESS_FIRST_ACCESS)


def last(spark, *pairs):
    return spark.createDataFrame([(a, b, False) for a, b in pairs], ADDRESS_LAST_ACCESS)


def test_upsert(spark, tmp_path):
    got = sinks.upsert_keyed_state(
        first(spark, ("0xa", 5), ("0xb", 7)),
        first(spark, ("0xa", 9), ("0xb", 3), ("0xc", 1)),
        str(tmp_path / "state"),
        ["address"],
        "version",
    )
    assert rows(got, "address", "block_number") == [("0xa", 5), ("0xb", 3), ("0xc", 1)]


def test_state_is_the_same_before_and_after_folds(spark, tmp_path):
    state = sinks.KeyedState(spark, str(tmp_path / "s"), ADDRESS_LAST_ACCESS, ["address"], "block_number")
    assert rows(state.read()) == []
    assert state.append(last(spark, ("0xa", 5), ("0xb", 7)), 0, 9, 1) == 2
    state.append(last(spark, ("0xa", 5), ("0xb", 7)), 0, 9, 2)
    state.append(last(spark, ("0xa", 15)), 10, 19, 3)
    want = [("0xa", 15), ("0xb", 7)]
    assert state.pending() == 2
    assert rows(state.read(), "address", "block_number") == want
    state.fold()
    assert state.pending() == 0
    assert rows(state.read(), "address", "block_number") == want
    state.fold()
    state.append(last(spark, ("0xb", 22), ("0xc", 21)), 20, 29, 4)
    want = [("0xa", 15), ("0xb", 22), ("0xc", 21)]
    assert rows(state.read(), "address", "block_number") == want
    state.fold()
    assert rows(state.read(), "address", "block_number") == want


def test_later_run_wins_at_an_equal_block(spark, tmp_path):
    state = sinks.KeyedState(spark, str(tmp_path / "s"), ADDRESS_LAST_ACCESS, ["address"], "block_number")
    state.append(last(spark, ("0xa", 5)).selectExpr("address", "block_number", "true AS is_deleted"), 0, 9, 1)
    state.fold()
    state.append(last(spark, ("0xa", 5)), 0, 7, 2)
    assert rows(state.read()) == [("0xa", 5, False)]


def test_unfinished_fold_is_ignored(spark, tmp_path):
    path = tmp_path / "s"
    state = sinks.KeyedState(spark, str(path), ADDRESS_LAST_ACCESS, ["address"], "block_number")
    state.append(last(spark, ("0xa", 5)), 0, 9, 1)
    (path / "generation=1" / "base").mkdir(parents=True)
    assert rows(state.read(), "address", "block_number") == [("0xa", 5)]
    state.fold()
    assert rows(state.read(), "address", "block_number") == [("0xa", 5)]
    assert os.path.exists(path / "generation=1" / "base" / "_SUCCESS")


def test_hash_layout_files_are_sorted(spark, tmp_path):
    df = spark.range(2000).selectExpr("concat('0x', id % 300) AS address", "(id * 37) % 2000 AS block_number")
    hash_layout(df).write.partitionBy(ADDRESS_PART).parquet(str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.count() == 2000
    assert got.select(ADDRESS_PART).distinct().count() == 16
    for part in sorted((tmp_path / "t").glob("*/*.parquet")):
        content = spark.read.parquet(str(part)).toPandas()
        assert content.equals(content.sort_values(["address", "block_number"]).reset_index(drop=True))


def test_composite_layout_spreads_a_hot_address(spark):
    df = spark.range(4000).selectExpr("'0xhot' AS address", "cast(id AS string) AS slot_key")
    sizes = [len(p) for p in hash_layout_composite(df, n=8).rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


@pytest.fixture
def folder(spark, tmp_path):
    """Two good files, an empty one, one without a footer, one broken after its first rows."""
    path = tmp_path / "in"
    path.mkdir()

    def file(df, name):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        part = next((tmp_path / name).glob("part-*.parquet"))
        shutil.copy(part, path / f"{name}.parquet")

    accounts = spark.range(30000).selectExpr("sha2(cast(id AS string), 256) AS address")
    file(accounts.where("id < 10"), "1")
    file(accounts.where("id BETWEEN 10 AND 29"), "2")
    file(accounts.where("id BETWEEN 30 AND 32"), "with space")
    file(accounts.where("id BETWEEN 33 AND 34"), "d#1")
    file(accounts.where("id = 35"), "50%")
    for n, sub in enumerate(("d=1", "d=2"), 36):
        (path / sub).mkdir()
        file(accounts.where(f"id = {n}"), f"{sub}/same")
    file(accounts.where("id < 0"), "3")
    (path / "4.parquet").write_bytes(b"this is no parquet file")
    pq.write_table(accounts.toArrow(), path / "5.parquet", row_group_size=10000)
    at = pq.ParquetFile(path / "5.parquet").metadata.row_group(1).column(0).data_page_offset
    content = bytearray((path / "5.parquet").read_bytes())
    content[at : at + 50] = b"\xff" * 50
    (path / "5.parquet").write_bytes(content)
    (path / "notes.txt").write_text("not a table")
    return str(path)


def test_report_lists_every_file(spark, folder):
    report = bulk_load.load_report(spark, folder, delay=0)
    assert rows(report, "file", "rows", "status") == [
        ("1.parquet", 10, "loaded"),
        ("2.parquet", 20, "loaded"),
        ("3.parquet", 0, "loaded"),
        ("4.parquet", 0, "failed"),
        ("5.parquet", 0, "failed"),
        ("50%.parquet", 1, "loaded"),
        ("d#1.parquet", 2, "loaded"),
        ("same.parquet", 1, "loaded"),
        ("same.parquet", 1, "loaded"),
        ("with space.parquet", 3, "loaded"),
    ]
    assert all((r["error"] is None) == (r["status"] == "loaded") for r in report.collect())
    assert rows(bulk_load.load_summary(report)) == [(10, 8, 2, 80.0, 38)]


def test_a_large_empty_file_is_sound(spark, tmp_path):
    schema = pa.schema([("address", pa.string())], metadata={"note": "x" * 3_500_000})
    (tmp_path / "in").mkdir()
    pq.write_table(schema.empty_table(), tmp_path / "in" / "empty.parquet")
    report = bulk_load.load_report(spark, str(tmp_path / "in"), delay=0)
    assert rows(report, "status", "rows", "error") == [("loaded", 0, None)]


def test_a_partial_load_has_to_be_allowed(spark, folder, tmp_path):
    with pytest.raises(bulk_load.PartialLoad, match="4.parquet") as failure:
        bulk_load.load_parquet_folder(spark, folder, str(tmp_path / "out"), delay=0)
    assert failure.value.report.where("status = 'failed'").count() == 2
    assert not list((tmp_path / "out").glob("part-*"))


def test_broken_files_contribute_nothing(spark, folder, tmp_path):
    got = bulk_load.load_parquet_folder(spark, folder, str(tmp_path / "out"), allow_partial=True, delay=0)
    assert got.table.count() == 38
    assert got.table.distinct().count() == 38
    assert got.report.where("status = 'failed'").count() == 2
    again = bulk_load.load_parquet_folder(spark, folder, str(tmp_path / "out"), allow_partial=True, delay=0)
    assert again.table.count() == 76


def test_a_sound_folder_is_decoded_once(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("cast(id AS string) AS address").repartition(4).write.parquet(str(tmp_path / "in"))
    pq.write_table(pa.schema([("address", pa.string())]).empty_table(), tmp_path / "in" / "empty.parquet")

    def examined(*args):
        raise AssertionError("a sound folder needs no second look")

    monkeypatch.setattr(bulk_load, "load_report", examined)
    got = bulk_load.load_parquet_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), delay=0)
    assert got.table.count() == 50
    assert rows(bulk_load.load_summary(got.report)) == [(5, 5, 0, 100.0, 50)]


def test_many_files_without_rows_are_told_apart_in_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    empty = pa.schema([("address", pa.string())]).empty_table()
    for k in range(40):
        pq.write_table(empty, tmp_path / "in" / f"empty-{k}.parquet")
        (tmp_path / "in" / f"broken-{k}.parquet").write_bytes(b"PAR1" + bytes(k) + b"PAR1")
    report = bulk_load.load_report(spark, str(tmp_path / "in"), delay=0)
    assert rows(bulk_load.load_summary(report)) == [(80, 40, 40, 50.0, 0)]
    assert {r["error"].split(":")[0] for r in report.where("status = 'failed'").collect()} == {"unreadable footer"}
    monkeypatch.setattr(bulk_load, "SUSPECT_BYTES", 4)
    report = bulk_load.load_report(spark, str(tmp_path / "in"), delay=0)
    assert rows(bulk_load.load_summary(report)) == [(80, 0, 80, 0.0, 0)]


def test_missing_folder(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bulk_load.load_parquet_folder(spark, str(tmp_path / "none"), str(tmp_path / "out"), delay=0)


def test_shared_dir_is_fresh_and_configured(spark):
    a, b = shared_dir(spark), shared_dir(spark)
    assert a != b
    assert a.startswith(spark.conf.get("spark.checkpoint.dir"))

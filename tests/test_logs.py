"""Failed work units from error logs."""

from __future__ import annotations

import pytest
from micro import rows

from stateloom.streaming.logs import extract_failed_units


def test_entries_between_separator_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "--\n"
        "2024 timeout (query: INSERT INTO t -- not a separator\nSELECT f(x) FROM file('/d/12.parquet'))\n"
        "--\n"
        "no query here\n"
        "--\n--\n"
        "lost (query: SELECT 1)   \n"
        "--"
    )
    (tmp_path / "b.log").write_text("x (query: SELECT a FROM '/d/7.parquet')\r\n--\r\ny (query: SELECT b)\r\n")
    (tmp_path / "empty.log").write_text("")
    assert rows(extract_failed_units(spark, str(tmp_path))) == [
        ("a.log", "INSERT INTO t -- not a separator\nSELECT f(x) FROM file('/d/12.parquet')", "12.parquet"),
        ("a.log", "SELECT 1", "unknown"),
        ("b.log", "SELECT a FROM '/d/7.parquet'", "7.parquet"),
        ("b.log", "SELECT b", "unknown"),
    ]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_a_large_log_is_read_in_splits(spark, tmp_path, newline):
    entry = "failed {n}\n(query: SELECT * FROM file('/d/{n}.parquet') -- {pad})\n--\n"
    with open(tmp_path / "big.log", "w", newline=newline) as log:
        for n in range(3000):
            log.write(entry.format(n=n, pad="x" * 200))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        got = extract_failed_units(spark, str(tmp_path), newline)
        assert got.rdd.getNumPartitions() > 3
        assert got.count() == 3000
        assert got.select("file_name").distinct().count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")

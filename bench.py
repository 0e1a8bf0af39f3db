"""Time the headline queries and print one JSON line.

``python bench.py NAME...`` times those queries only, ``python bench.py --chunks``
the incremental runner. ``BENCH_SF_DIR`` is the folder of given tables, ``BENCH_CPUS`` the number of
local threads, ``BENCH_RUNS`` the timed runs per query behind a warm-up of all.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stateloom.plans.registry import TABLES  # noqa: E402
from stateloom.sources.files import shared_dir  # noqa: E402
from stateloom.sources.inputs import Inputs  # noqa: E402
from stateloom.streaming.runner import Warehouse  # noqa: E402
from workload import adapter  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [*TABLES, "latest_per_key", "agg_mergeable", "write_block_facts", "run_incremental"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stateloom-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(spark: SparkSession) -> str:
    """The given tables with a file for each core: small ones come as a single row group."""
    folder = f"{shared_dir(spark)}/given"
    for table in sorted({view.table for view in adapter.VIEWS.values()}):
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        rows.repartition(CPUS, rows.columns[0]).write.parquet(f"{folder}/{table}.parquet")
    return folder


def timed(spark: SparkSession, name: str, folder: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def queries(spark: SparkSession, names: list[str]) -> dict:
    folder = spread(spark)
    for name in names:
        timed(spark, name, folder)
    seconds = {
        name: round(statistics.median(timed(spark, name, folder) for _ in range(RUNS)), 3) for name in names
    }
    return {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
    }


def chunk_sizes(spark: SparkSession, key: str = "address_diffs") -> dict:
    """Blocks per second of a chunked run over stored inputs, by chunk size."""
    root = shared_dir(spark)
    for name, df in adapter.inputs(spark, SF_DIR).tables.items():
        df.write.parquet(f"{root}/inputs/{name}")
    stored = Inputs.from_parquet(spark, f"{root}/inputs", versions=adapter.VERSIONS)
    blocks = stored.max_block("transaction").first()[0] + 1
    speed = {}
    for label, step in (("warm-up", blocks), ("all", blocks), ("10000", 10_000), ("1000", 1_000)):
        registry = {key: replace(TABLES[key], bucket_width=step)}
        warehouse = Warehouse(spark, f"{root}/{label}", stored, adapter.FORKS, registry)
        began = time.perf_counter()
        warehouse.run_incremental(key, 0, blocks - 1, step)
        speed[label] = round(blocks / (time.perf_counter() - began), 1)
    del speed["warm-up"]
    return {"metric": f"blocks_per_second_{key}", "value": speed["10000"], "unit": "1/sec", "chunks": speed}


def main() -> None:
    spark = session()
    names = sys.argv[1:]
    print(json.dumps(chunk_sizes(spark) if names == ["--chunks"] else queries(spark, names or HEADLINE)))
    spark.stop()


if __name__ == "__main__":
    main()

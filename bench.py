"""Benchmark: the 34 analyses over stored five-table data.

The five tables are derived once from ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and written as Parquet below the session's checkpoint
directory - the analyses then run against stored tables, as they would
against a warehouse.  One warm-up pass runs every analysis once; then each
analysis runs once more and ``$BENCH_RUNS`` (default 5) timed times back to
back; the median is reported (warm latency).  The timed runs are then repeated
without broadcast joins, as for tables too large for them.  Execution is
forced with the ``noop`` sink so nothing is collected to the driver.

Prints one JSON line:
{"metric": "sum_median_sec_34_queries", "value": N, "unit": "sec",
 "queries": {...}, "sf": ..., ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from shoplens.operators import OPERATORS  # noqa: E402
from shoplens.session import checkpoint_dir, get_spark, scratch_path  # noqa: E402
from shoplens.sources import (  # noqa: E402
    from_driver_dir,
    read_parquet_tables,
    write_bucketed_tables,
    write_parquet_tables,
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    layout = os.environ.get("BENCH_LAYOUT", "bucketed")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = get_spark(
        f"local[{cpus}]",
        app="shoplens-bench",
        conf={
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "16g",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("BENCH_ADVISORY", "16m"),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": os.environ.get("BENCH_PARFIRST", "true"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shoplens-wh-"),
            "spark.sql.autoBroadcastJoinThreshold": os.environ.get("BENCH_BROADCAST", "10m"),
        },
    )
    # the master is local here; a folder of our own is made only where the session names none
    if not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="shoplens-ckpt-"))
    store = scratch_path(spark, "bench-tables")

    t0 = time.perf_counter()
    derived = from_driver_dir(spark, sf_dir)
    if layout == "bucketed":
        # session-keyed tables bucketed by website_session_id: the session-grain
        # aggregates and joins of the analyses read co-partitioned data
        tables = write_bucketed_tables(spark, derived, store, buckets=cpus)
    else:
        write_parquet_tables(derived, store)
        tables = read_parquet_tables(spark, store)
    prep = time.perf_counter() - t0

    names = only or list(OPERATORS)

    def once(name: str) -> float:
        s = time.perf_counter()
        OPERATORS[name](tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - s

    def timed() -> dict[str, float]:
        times: dict[str, float] = {}
        for name in names:  # warm: one more run, then the timed runs back to back
            once(name)
            times[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
        return times

    for name in names:  # warm-up pass over every analysis (JIT, codegen caches)
        once(name)
    times = timed()
    # the plans meant for large tables: no side is small enough to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = timed()

    print(
        json.dumps(
            {
                "metric": "sum_median_sec_34_queries",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "value_no_broadcast": round(sum(shuffled.values()), 4),
                "queries_no_broadcast": shuffled,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
                "prep_sec": round(prep, 3),
                "layout": layout,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: run every registered query and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (default 2; the best run counts).  Each query
is executed in full with the ``noop`` sink (no driver collect), so the time
is the cluster work of the plan.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ticksmith.plans.catalog import QUERIES  # noqa: E402

HEADLINE = ["parse_ticks", "stage_ticks", "bars_5min", "daily_summary", "top_movers",
            "quality_results", "stream_bars"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    scratch = tempfile.mkdtemp(prefix="ticksmith-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .appName("ticksmith-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(2 * cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.checkpoint.dir", scratch)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(scratch)

    # warm the JVM (class loading, codegen cache) outside the timed runs
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        best = float("inf")
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - t0)
        except Exception as e:   # report the failure, keep timing the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "headline": {k: times[k] for k in HEADLINE if k in times},
        "sf": float(m.group(1)) if m else None,
        "master": f"local[{cpus}]",
        "repeat": repeat,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

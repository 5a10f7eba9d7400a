"""Benchmark: the full warehouse build and every registered query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely with the ``noop`` sink (no driver
collect).  A warm-up pass (the build and the warehouse queries on the
smallest test scale, when present) runs first so JIT compilation is not
billed to the first query; its time is reported as ``warmup_sec`` and is not
part of ``value``.  Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layercake.plans.registry import QUERIES  # noqa: E402
from layercake.plans.warehouse import warehouse  # noqa: E402
from layercake.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app_name="layercake-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    t0 = time.time()
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in ("yearly_trend", "customers_report", "products_report", "silver_sales",
                     "surrogate_key_dense"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.time() - t0, 3)

    times: dict[str, float] = {}
    t0 = time.time()
    warehouse(spark, sf_dir)  # adapter -> silver -> gold, dims and fact materialised
    times["warehouse_build"] = round(time.time() - t0, 3)

    failed: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            failed[name] = f"{type(e).__name__}: {e}"[:300]
            print(f"{name:28s} FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(time.time() - t, 3)
        print(f"{name:28s} {times[name]:8.2f}s", file=sys.stderr)

    total = round(sum(times.values()), 3)
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "warmup_sec": warmup}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

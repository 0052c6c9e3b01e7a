"""Benchmark: run the registered queries on the driver tables and time them.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_REPEAT (default 1).
Each query is fully executed with the ``noop`` sink (every row produced, none
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeshore.plans.registry import QUERIES  # noqa: E402
from lakeshore.session import get_session, path_bytes, tune_for_input  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="lakeshore-bench",
                        extra={"spark.driver.memory": "16g"})
    names = [n for n in QUERIES if not only or n in only]
    tune_for_input(spark, path_bytes(spark, sf_dir))

    # Warm-up: run every query once on the smallest scale next to the target
    # (same plans, so class loading and generated code are reused); the timed
    # runs then measure data work, not JVM start-up.
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

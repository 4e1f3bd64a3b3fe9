"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (no collection to the
driver).  Prints one JSON line with per-query seconds and their sum.
Set BENCH_QUERIES=name1,name2 to run a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.queries import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    default_parts = cpus if cpus.isdigit() else str(os.cpu_count() or 8)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", default_parts)),
                          app="tillroll-bench")
    # JVM warm-up (class loading, JIT, code generation) on the smallest
    # fixture, a different data set, untimed per query; its total is reported.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.perf_counter()
    if warm_dir and os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir:
        for name, fn in QUERIES.items():
            if wanted and name not in wanted:
                continue
            fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
    warmup = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup_sec": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

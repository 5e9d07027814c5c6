"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best time is reported).
Each query runs to completion through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import registry  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = ["latest_cells", "filter_column_value", "decode_typed", "bulk_load_sorted", "knn_geohash", "latest_cells_stored",
            "filter_column_value_stored", "decode_typed_stored", "scan_range_stored", "bulk_get_stored", "latest_cells_bucketed"]
WRITES_FIRST = ("_stored", "_bucketed")  # these write the log they read when they are built, which is not timed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="tessera-bench")
    qs = registry.queries()
    # warm-up: JVM, codegen caches and file listing
    qs["catalog_read"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = qs[name](spark, sf_dir)
            if name.endswith(WRITES_FIRST):
                t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_best_of_%d" % repeat, "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Protocol: local[BENCH_CPUS], UI off, session zone UTC; the raw trip layer is
staged once (timed as ``stage_raw``), then each query runs 1 warm-up + 3
timed runs forced through the ``noop`` sink; the median is reported.  Prints
ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "clean_trips", "gold_trips", "gold_bucket", "gold_passengers", "rule_violations",
    "quality_report", "gold_trips_iqr", "dedup_trips", "ingest_stream", "layers_gold_trips",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from meterline.registry import QUERIES
    from meterline.session import build_session
    from meterline.sources.fixture import landing_path

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    t0 = time.perf_counter()
    landing_path(spark, sf_dir)
    stage = time.perf_counter() - t0

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINE:
        once(name)  # warm-up
        timings[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    rows = spark.read.parquet(landing_path(spark, sf_dir)).count()
    label = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(label)
    except ValueError:
        sf = label
    print(json.dumps({
        "metric": "headline_median_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "stage_raw": round(stage, 3),
        "raw_rows": rows,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

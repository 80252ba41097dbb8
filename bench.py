"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local threads), BENCH_RUNS (timed runs per query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from gridtide.session import build_session  # noqa: E402

HEADLINE = (
    "c8_interpolate_in_time", "c7_quality_report", "p_calendar_features",
    "a1_basic_statistics", "a2_peak_valley", "a5_monthly_statistics", "a8_hourly_statistics", "a10_event_box_statistics",
    "a13_load_histogram", "a14_load_density", "a15_empirical_cdf", "a16_correlation_matrix", "a18_sampling_hours",
    "w1_w2_differences", "w4_autocorrelation", "w7_event_spectrum", "d1_decompose", "a25_a26_component_energy",
    "f4_f8_single_forecast", "f5_hybrid_forecast",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        # The first run compiles code and starts Python workers.
        times[name] = round(statistics.median(took[1:]), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

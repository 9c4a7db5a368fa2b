"""Time the headline queries and print one JSON line.

Each query is run `BENCH_RUNS` times, the first run is dropped and the median kept. Results
are written to the no-op sink, so every row and column is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from haulmark.session import build_session
from suite.queries import QUERIES

HEADLINE = (
    "enrich_positions",
    "enrich_positions_delta",
    "flat_file",
    "interval_join_bucketed",
    "interval_join_composite_key",
    "incremental_delta",
    "snapshot_dimension",
    "latest_by_maxima",
    "argmax_with_ties",
    "asof_cumulative_count",
    "time_since_previous",
    "fault_causes",
    "usage_vs_failures",
    "usage_rate",
    "pm_margin",
    "maintenance_timeline",
    "failures_by_make_model",
    "survival_dataset",
    "survival_by_make_site",
    "pm_compliance",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(int(os.environ.get("BENCH_RUNS", "3")), 2)
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    result = {
        "metric": "median seconds per query, summed over the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

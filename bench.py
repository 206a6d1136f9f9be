"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5).
Four warm-up rounds run every query first (JVM and code-generation warm-up
spread over all of them), then the timed rounds interleave the queries.
Each timing is wall-clock from building the DataFrame until ``collect()``
returns; the reported value per query is the median of its timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gatewatch.catalog import QUERIES  # noqa: E402
from gatewatch.session import local_session  # noqa: E402

WARMUP = 4
HEADLINE = ("watchlist_hits", "hits_lookback", "report_day_1", "report_night")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    times: dict[str, list[float]] = {name: [] for name in HEADLINE}
    rows = {}
    for i in range(WARMUP + runs):
        for name in HEADLINE:
            t0 = time.perf_counter()
            out = QUERIES[name](spark, sf_dir).collect()
            dt = time.perf_counter() - t0
            if i >= WARMUP:
                times[name].append(dt)
            rows[name] = len(out)
    medians = {name: round(statistics.median(ts), 3) for name, ts in times.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "median_query_seconds_total",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "runs_sec": {name: [round(t, 3) for t in ts] for name, ts in times.items()},
                "rows": rows,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

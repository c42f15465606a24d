"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (full execution, nothing
collected). One warm-up pass, then the median of $BENCH_REPS timed runs per
query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_full",
    "count_by_city",
    "monthly_counts",
    "filtered_count_all",
    "crosstab_top",
    "correlation_matrix",
    "daily_series",
    "build_postings",
    "term_df",
    "bm25_topk",
    "bm25_topk_filtered",
    "like_search",
    "stats_context",
    "ask_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from civiq.registry import REGISTRY
    from civiq.session import get_session

    events = tempfile.mkdtemp(prefix="civiq-bench-events-")
    spark = get_session(f"local[{cpus}]", cpus, app_name="civiq-bench", extra={
        "spark.driver.memory": "16g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": events,
    })
    names = [n for n in HEADLINE if n in REGISTRY]
    times: dict[str, float] = {}
    for name in names:
        fn = REGISTRY[name][0]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

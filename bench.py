"""Headline-query benchmark.

Runs the main registered queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is written to Spark's ``noop`` sink, which computes every output
column (``count()`` would let the optimizer prune most of the work) without
collecting rows to the driver.  One warm-up pass, then the median of
``$BENCH_RUNS`` (default 3) timed runs per query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlewick.plans.catalog import QUERIES  # noqa: E402
from candlewick.session import build_session  # noqa: E402

HEADLINE = [
    "candles",
    "inject_defects",
    "clean_candles",
    "dq_report",
    "volatility_ranking",
    "activity_ranking",
    "activity_by_hour",
    "market_summary",
    "balanced_sample",
    "dedup_by_candle_key",
    "parse_request_log",
    "rate_window_counts",
    "max_concurrency",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app_name="candlewick-bench", shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:
        run(name)
    medians = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

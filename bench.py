"""Time the headline queries (or all of them with ``--all``) and print one JSON line.

Each query is built and drained into the no-op sink ``BENCH_RUNS`` times after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tracklens.session import local_session
from tracklens.workload.all_queries import QUERIES

HEADLINE = [
    "shelf",
    "document_search",
    "book_upsert",
    "book_changes",
    "book_tally",
    "track_rollup",
    "count_reconcile",
    "dataset_diff",
    "quiz_score",
    "checklist_done",
    "register_layout",
    "register_map",
    "ramp_limit",
    "adaptive_limit",
    "dispatch",
    "error_integral",
    "align_asof",
    "response_ok",
    "downsample",
    "setpoint_chain",
    "block_assign",
    "tick_assign",
    "recur_expand",
    "page_sections",
    "stream_ramp",
    "stream_trend",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("tracklens-bench", cpus=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE

    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]) if runs else taken[0], 3)
        if "--all" in sys.argv:
            print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

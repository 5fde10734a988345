"""Headline-query timings.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline mart over its whole input on local[BENCH_CPUS] and prints
one JSON line (``value``: the marts; the write jobs are listed beside them).  Each query is timed (best of BENCH_REPS, default 2: the host is
noisy) to full materialisation (a ``noop``
write: every row computed, nothing collected to the driver) after one
warm-up run of the whole set (JVM start, code generation).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["payment_summary", "payment_detail", "payment_summary_v2", "budget_integrations",
            "weekly_profit", "section_carry", "detail_aggregate_join", "account_totals"]
# Jobs that write: a month load of both marts (backfill and one month again), and the export.
JOBS = ["replace_slice", "export_detail"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "2"))
    from vitrina.plans.registry import QUERIES
    from vitrina.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app="vitrina-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up
        run(name)
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(name) for _ in range(reps)), 3)
    for name in JOBS:  # long enough to be timed once
        times[name] = round(run(name), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_marts_total", "value": round(sum(times[n] for n in HEADLINE), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

Every query is run to completion into a no-op sink: one warm-up, then the median
of three runs. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from spanledger.session import build_session
from spanledger.workloads.queries import QUERIES

HEADLINE = [
    "consolidate_all_or_nothing", "consolidate_islands", "assign_ids_initial", "assign_ids_incremental",
    "consolidate_by_marks", "change_history_hot", "scd2_merge", "scd2_dbt_final", "dim_contracts", "amount_change_history", "fct_contract_metrics",
    "flatten_json", "flatten_json_deduplicated", "route_tagged", "dedup_latest",
    "profile_basic", "profile_stats", "correlation_matrix", "iqr_outliers", "upsert_by_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("spanledger-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": str(max(int(cpus), 1)),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

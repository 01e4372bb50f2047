"""Times the headline queries over BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query is run once unmeasured and three times measured, its whole result computed and thrown
away; the median counts. `--all` times every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallyhouse.checks.queries import all_queries
from tallyhouse.session import build_session

HEADLINE = (
    "job_dim_customer", "job_dim_loan", "job_dim_payment_schedule", "job_fct_collection_detail",
    "insurance_plan_merge", "merge_sliced", "payment_failed_cascade", "agg_collected_active", "stg_interest_union",
    "lookup_first_by_order", "lookup_eav", "dedupe_latest", "anti_join_double", "filter_change_window",
    "clean_money", "recon_data_equal", "recon_keyed_diff", "recon_null_counts", "recon_summary", "agg_rule_violations",
    "audit_next_window", "star_and_marts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", app="bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    names = list(queries) if "--all" in sys.argv else HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds over all queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

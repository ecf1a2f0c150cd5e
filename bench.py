"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from tallyhouse.plans.catalog import queries
from tallyhouse.session import local_session

HEADLINE = [
    "t1_label_store", "t2_loan_silver", "t3_wide_silver", "t4_wide_gold", "t7_financials_silver",
    "t8_engagement", "t9_risk", "t10_training_set", "t12_monitoring", "j1_join_sources", "w1_forward_fill",
    "w2_forward_backward_fill", "w5_latest_per_key", "i1_median_fill_by_snapshot", "e3_multi_hot", "g1_lagged_pivot",
    "g2_bad_rate_curve", "g6_deciles", "l5_auc", "mo1_stability_index", "mo6_histogram", "mo7_five_numbers",
    "s7_rerun_one_month", "d4_backfill",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    known = queries()
    took: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):  # the first run compiles
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            best = seconds if best is None else min(best, seconds)
        took[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dayledger.catalog import QUERIES  # noqa: E402
from dayledger.session import local_session  # noqa: E402

HEADLINE = (
    "d22_gate_customers",
    "d22_gate_orders",
    "d22_gate_payments",
    "w04_latest_version",
    "m02_orders",
    "m03_payments",
    "m04_order_funnel_stages",
    "m05_orders_with_customer_dim",
    "m06_orders_by_hour_dow",
    "m07_customer_first_order",
    "m09_payment_retries_distribution",
    "m10_customer_cohort_retention",
    "m12_dq_reason_breakdown",
    "m14_order_stage_durations",
    "m15_orders_with_sequence",
    "q01_gmv_total",
    "q07_gmv_by_day",
    "q15_gmv_by_city_top10",
    "q24_payment_success_by_day",
    "q26_stage_hours",
    "q31_new_and_repeat_orders_by_day",
    "v13_payment_not_before_order",
    "r01_open_orders",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # noop computes every column of every row and keeps nothing.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:  # compile and warm up; the second run of each counts
        run(name)
    timings = {name: run(name) for name in HEADLINE}
    scale = Path(sf_dir).name.removeprefix("sf")
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

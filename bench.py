"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the input folder, ``BENCH_CPUS`` the number of local threads. Each query runs
to completion into a sink that drops the rows; the faster of two runs counts, after cleaned tables
that reports read have been built (their building is timed by its own queries). ``merge_only`` times the change
merges again without the writing and full load of the tables they go to; it is not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidewater.session import build_session
from tidewater.verification.queries import (
    prepared_customer_merge,
    prepared_lineitem_merge,
    prepared_orders_merge,
    queries,
)

HEADLINE = (
    "orders_silver_full",
    "customer_silver_full",
    "lineitem_silver_full",
    "orders_cdc_merge",
    "customer_cdc_merge",
    "lineitem_cdc_merge",
    "orders_change_feed",
    "csv_bulk_load",
    "pipe_incremental",
    "daily_sales_summary",
    "daily_sales_history",
    "daily_sales_upsert",
    "customer_ltv",
    "customer_ltv_merge",
    "customer_rfm",
    "monthly_sales",
    "spend_quartiles",
    "customers_per_country",
    "orders_by_status_desc",
    "top_part_types",
    "monthly_status_profile",
    "null_counts",
    "key_uniqueness",
    "rule_violations",
    "masked_analyst",
    "vw_customer_summary",
)


MERGES = {
    "orders_cdc_merge": prepared_orders_merge,
    "customer_cdc_merge": prepared_customer_merge,
    "lineitem_cdc_merge": prepared_lineitem_merge,
}


def merge_seconds(spark, sf_dir: str, name: str) -> float:
    merge = MERGES[name](spark, sf_dir)
    start = time.perf_counter()
    merge().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tidewater-bench",
        f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        # Small local data: let rebalanced writes use all threads.
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    names = sys.argv[1:] or HEADLINE
    registered["rule_violations"](spark, sf_dir)  # builds the cleaned tables
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    merges = {name: merge_seconds(spark, sf_dir, name) for name in MERGES if name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "merge_only": merges,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

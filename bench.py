"""Headline timings: one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local
cores.  Every query runs ``BENCH_RUNS`` times to completion; the best counts.
"""

from __future__ import annotations

import json
import os
import time

from strata.checks import registry
from strata.session import local_session

HEADLINE = (
    "dedupe_latest",
    "fct_orders",
    "dim_customers",
    "agg_revenue_daily",
    "agg_customer_ltv",
    "row_hash",
    "scd2_merge",
    "scd2_merge_small_batch",
    "fct_orders_merge",
    "dim_customers_merge",
    "cdc_apply",
    "stg_events_incremental",
    "schema_sync",
    "bronze_append",
    "gold_build",
    "gold_incremental",
    "as_of_version",
    "bucketed_merge",
    "paged_source",
    "decode_messages",
    "stream_bronze",
    "compact",
    "zorder",
    "quality_gate",
    "federated_join",
    "vector_topk",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "strata-bench")
    spark.sparkContext.setLogLevel("ERROR")
    available = registry.queries()
    timings = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        timings[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

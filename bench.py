"""Time the headline queries and print one JSON line.

The stored marts are built first and timed apart, as ``build_marts``; the total holds it.

BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_QUERIES comma-separated names or prefixes*, or "all" (default: the headline queries)
"""

from __future__ import annotations

import fnmatch
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martwright.registry import CASES  # noqa: E402
from martwright.registry.base import build_marts, registered_domain  # noqa: E402
from martwright.session import local_session  # noqa: E402

HEADLINE = [
    "stg_commercial_lineitems",
    "int_order_items",
    "fct_orders_v1",
    "int_customer_orders",
    "dim_customers_v1",
    "fct_revenue_v1",
    "fct_attribution_v1",
    "fct_usage_v1",
    "fct_orders_enriched",
    "metric_gross_revenue_by_month",
    "metric_gross_net_by_segment",
    "metric_aov_by_tier",
    "metric_discount_rate_by_segment",
    "metric_all_total",
    "metric_daily_gap_filled",
    "metric_reconciliation",
    "check_suite_platform",
    "check_suite_commercial",
    "contract_constraints",
    "contract_coerced_fct_orders",
    "profile_lineitem",
    "suggest_checks",
    "catalog_reach",
    "catalog_scorecard",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    wanted = os.environ.get("BENCH_QUERIES", "")
    patterns = ["*"] if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    names = [n for n in CASES if any(fnmatch.fnmatch(n, p) for p in patterns)]

    fresh = tempfile.mkdtemp(prefix="martwright-bench-")  # no mart of an earlier run is there
    spark = local_session("bench", cpus, **{"spark.sql.warehouse.dir": fresh})
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the JVM before timing
    seconds: dict[str, float] = {}
    started = time.perf_counter()
    build_marts(registered_domain(spark, folder))  # what the queries on stored marts read
    seconds["build_marts"] = round(time.perf_counter() - started, 3)
    for name in names:
        started = time.perf_counter()
        CASES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

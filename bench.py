"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then three times into a no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martloom.registry import QUERIES
from martloom.session import get_session

HEADLINE = (
    "scan_parquet", "key_profile", "copy_into_idempotent",
    "silver_sales_header", "silver_sales_details", "dedup_latest", "dq_report",
    "dim_calendar", "fct_sales_details", "fct_sales_returns", "fct_cost_history", "fct_finance",
    "v_sales_transactions", "v_income_statement",
    "tq_net_sales_total", "tq_net_sales_by_region", "tq_top_products", "tq_margin_by_category",
    "tq_return_rate", "tq_active_customers", "measures_by_year", "measures_composed",
    "time_intelligence", "tq_customers_by_segment",
    "tq_dre_lines", "tq_top_deviation", "va_pct_account", "dre_subtotals",
    "rfm", "reco_actions", "pvm_drivers", "pvm_closure", "forecast_by_series", "intent_tagging",
    "orphan_audit", "grain_check", "reconcile_totals", "null_cost_share",
    "rls_filter", "usage_cost", "usage_by_tag", "query_latency",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

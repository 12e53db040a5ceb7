"""Time the registered queries and print one JSON line.

Each query runs to the end with all its columns (a ``noop`` write), once as a
warm-up and then BENCH_RUNS times; the median counts. The stored tables (raw
lines, star, dashboard lines) are built before and timed apart as ``build_*``.

By default the headline queries are timed; BENCH_ALL=1 times all of them.
BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_ONLY (names, comma-separated)
change the other defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tillroll.session import build_session
from tillroll.testbed import tables
from tillroll.testbed.queries import QUERIES

HEADLINE = [
    # from raw lines
    "transform", "coerce_customer_id", "clean_row_counts", "build_dim_product", "build_fact_sales",
    # models
    "stg_sales", "int_sales_enriched", "int_order_metrics", "int_customer_orders",
    "int_country_metrics", "mart_executive_kpis", "mart_customer_lifetime_value",
    "mart_repeat_purchase_metrics", "mart_country_revenue", "mart_sales_monthly",
    # analyses and extracts
    "avg_order_value", "customer_retention", "monthly_revenue", "repeat_purchase_rate",
    "top_customers", "fact_sales_enriched", "extract_country_revenue", "extract_top_products",
    # dashboard
    "clean_dashboard_fact", "executive_metrics", "customer_summary", "customer_metrics",
    "product_return_audit", "country_metrics", "data_quality_metrics", "concentration_shares",
    "return_risk_matrix",
    # semantic layer and checks
    "measures_fact", "cohort_retention", "new_vs_returning", "product_return_rate",
    "country_contribution", "run_quality_suite",
    # pages, sinks
    "page_view", "write_star", "export_bi_extracts",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    if os.environ.get("BENCH_ALL") == "1":
        names = list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {
        "build_raw_lines": timed(lambda: tables.raw_lines(spark, sf_dir)),
        "build_star": timed(lambda: tables.star(spark, sf_dir)),
        "build_dashboard_fact": timed(lambda: tables.dashboard_fact(spark, sf_dir)),
    }
    for name in names:
        query = QUERIES[name]
        run_all(query(spark, sf_dir))
        times = [timed(lambda: run_all(query(spark, sf_dir))) for _ in range(runs)]
        seconds[name] = statistics.median(times)
        print(f"{name} {seconds[name]:.3f}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once to warm
up and then three times; its time is the median of the three, over the whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from shopstar.queries import QUERIES
from shopstar.session import local_session

HEADLINE = (
    "bronze_ingest",
    "bronze_dq_violations",
    "silver_orders",
    "silver_order_items",
    "silver_returns",
    "silver_sessions",
    "scd1_addresses",
    "scd2_customers",
    "scd2_products",
    "surrogate_keys",
    "dim_customers",
    "dim_products",
    "fact_sales",
    "fact_sessions",
    "fact_web_analytics",
    "fact_returns",
    "customer_session_sequence",
    "mart_sales_summary",
    "mart_campaign_summary",
    "mart_abandonment_rate",
    "mart_customer_summary",
)
WARM_RUNS = 3


def timed(spark, key: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    scratch = tempfile.mkdtemp(prefix="shopstar-bench-")
    spark = local_session("shopstar-bench", cpus=cpus, scratch=scratch)
    cold, warm = {}, {}
    for key in HEADLINE:
        cold[key] = round(timed(spark, key, folder), 3)
        runs = [timed(spark, key, folder) for _ in range(WARM_RUNS)]
        warm[key] = round(statistics.median(runs), 3)
    report = {
        "metric": "headline_queries_total_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

"""One key holding a third of the rows: same results, and no task holds the whole key."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from shopstar.plans import facts
from shopstar.queries import QUERIES
from shopstar.session import tune
from tests.compare import both, connect

SMALL = "/root/testdata/sf0.001"
HOT = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey",
    "lineitem": (
        "CASE WHEN l_suppkey % 3 = 0 THEN 21 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN l_suppkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey"
    ),
    "events": (
        "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, "
        "CASE WHEN event_id % 3 = 1 THEN 'view' ELSE event_type END AS event_type"
    ),
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    if not os.path.isdir(SMALL):
        pytest.skip(f"no tables under {SMALL}")
    folder = tmp_path_factory.mktemp("hot")
    for name in ("region", "nation", "customer", "supplier", "part", *HOT):
        changed = f"* REPLACE ({HOT[name]})" if name in HOT else "*"
        duckdb.sql(f"SELECT {changed} FROM '{SMALL}/{name}.parquet'").write_parquet(
            str(folder / f"{name}.parquet")
        )
    return str(folder)


TOUCHED = [
    key
    for key in QUERIES
    if key.startswith(("fact_", "mart_", "session_", "customer_session", "bronze_dq", "load_run"))
]


@pytest.mark.parametrize("key", TOUCHED)
def test_hot_keys_do_not_change_results(spark, hot_dir, key):
    con = connect(hot_dir)
    ours, theirs = both(spark, con, hot_dir, key)
    assert ours == theirs


@pytest.fixture
def small_thresholds(spark):
    """Scale limits brought down to the size of a test."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def _lookup_inputs(spark):
    """Sessions of which a third belong to one user and a third to nobody."""
    user = "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 3 = 1 THEN NULL ELSE id % 997 END"
    moment = "TIMESTAMP_NTZ '2024-01-01 10:00:00'"
    sessions = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS website_session_id", f"{user} AS user_id", f"{moment} AS session_start"
    )
    views = spark.range(100).selectExpr(
        "id AS website_session_id", f"{moment} AS pageview_time"
    )
    orders = spark.range(100).selectExpr("id AS session_id")
    people = spark.range(0, 1000, 1, 4).selectExpr("id AS customer_id", "id + 1 AS customer_key")
    return sessions, views, orders, people


def test_adaptive_execution_splits_a_hot_lookup(spark, small_thresholds):
    sessions = facts.fact_sessions(*_lookup_inputs(spark))
    plan = _final_plan(sessions)
    assert "skew=true" in plan
    of_five = sum(i % 3 == 0 or (i % 3 == 2 and i % 997 == 5) for i in range(60_000))
    assert sessions.filter("customer_key = 6").count() == of_five
    assert sessions.filter("customer_key = -1").count() == 20_000


def test_a_hot_group_is_split_even_where_its_rows_would_stay_in_place(spark, small_thresholds):
    """Waiting time counts join and group by the same key; the hot customer is still cut."""
    visits = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 997 END AS customer_key", "id AS moment"
    )
    first = spark.range(0, 1000, 1, 4).selectExpr("id AS customer_key", "id + 30000 AS first_sale")
    waited = (
        visits.join(first, "customer_key")
        .filter("moment <= first_sale")
        .groupBy("customer_key")
        .agg(F.count("*").alias("n"))
    )
    tune(spark)
    plan = _final_plan(waited)
    assert "skew=true" in plan
    expected = sum(i % 3 == 0 or i % 997 == 5 for i in range(30_006))
    assert waited.filter("customer_key = 5").first().n == expected

"""Plans of all registered queries: nothing that would not hold on a large cluster."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shopstar.plans import marts
from shopstar.queries import QUERIES
from shopstar.session import SHUFFLE_PARTITION_BYTES, bytes_under, size_shuffles


@pytest.fixture
def no_small_tables(spark):
    """Plan as for tables that are too big to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(QUERIES))
def test_plan_scales(spark, sf_dir, no_small_tables, key):
    plan = physical(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    # No window over all rows in one task.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = " ".join(lines[max(0, i - 3) : i])
            assert "Window" not in above, above
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize(
    "key, scans, exchanges",
    [
        ("surrogate_keys", 1, 0),
        ("scd1_addresses", 12, 6),
        ("scd2_customers", 10, 6),
        ("fact_web_analytics", 5, 4),
        ("mart_customer_summary", 20, 40),
    ],
)
def test_keys_cost_a_plan_nothing(spark, sf_dir, key, scans, exchanges):
    """Keys are read from where they were stored once, in every branch of a plan."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(QUERIES[key](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("FileScan") <= scans
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) <= exchanges
    assert "rangepartitioning" not in plan


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = physical(QUERIES["mart_sales_summary"](spark, sf_dir))
    read = {m for schema in re.findall(r"ReadSchema: struct<([^>]*)", plan) for m in schema.split(",")}
    names = {column.split(":")[0] for column in read}
    assert "l_shipdate" not in names and "l_returnflag" not in names and "c_name" not in names
    tables = set(re.findall(r"/(\w+)\.parquet", plan))
    assert "part" not in tables and "nation" not in tables


def test_filters_reach_the_scan(spark, sf_dir):
    frame = QUERIES["silver_returns"](spark, sf_dir)
    assert "EqualTo(l_returnflag,R)" in physical(frame)


def test_single_partition_exchange_only_after_aggregation(spark):
    """The abandonment mart counts pages and sessions without an Expand or a window."""
    web = spark.range(10).select(F.lit("p").alias("page_name"), F.col("id").alias("session_key"))
    sessions = spark.range(10).select(
        F.col("id").alias("session_key"), F.lit(True).alias("resulted_in_sale")
    )
    plan = physical(marts.abandonment_rate(web, sessions))
    assert "Expand" not in plan and "Window" not in plan


def test_marts_aggregate_in_place(spark, sf_dir):
    """No distinct counts that need an Expand, no text in an aggregation buffer."""
    plan = physical(QUERIES["mart_sales_summary"](spark, sf_dir))
    assert "Expand" not in plan
    plan = physical(QUERIES["mart_customer_summary"](spark, sf_dir))
    assert "SortAggregate" not in plan and "Expand" not in plan


def test_dimensions_plan_their_joins_once(spark, sf_dir, no_small_tables):
    plan = physical(QUERIES["dim_products"](spark, sf_dir))
    assert len(re.findall(r"Join \[brand_id", plan)) == 1


def test_shuffles_follow_the_input(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "3")
        assert size_shuffles(spark, 1) == 3
        assert size_shuffles(spark, 10 * SHUFFLE_PARTITION_BYTES + 1) == 11
        assert spark.conf.get(name) == "11"
    finally:
        spark.conf.set(name, before)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    assert bytes_under(spark, str(tmp_path), str(tmp_path / "none")) == 5

"""Constraint checks and load metrics, computed by Spark over whole tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.functions import seconds_between, timestamp_lit
from shopstar.schemas import SourceTable

NOT_NULL, PRIMARY_KEY = "NOT NULL", "PRIMARY KEY"
SUCCESS, FAILED = "Success", "Failed"


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_violations(rows: DataFrame, table: SourceTable) -> DataFrame:
    """NULLs per mandatory column and rows beyond the first per key, in one pass.

    Rows are combined per key on the map side first, so a key repeated by a third of the
    table reaches the shuffle as one row per task.
    """
    nulls = {c: f"n{i}" for i, c in enumerate(table.required)}
    per_key = rows.groupBy(table.key).agg(
        F.count("*").alias("n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(n) for c, n in nulls.items()],
    )
    surplus = F.when(F.col(table.key).isNotNull(), F.col("n") - 1)
    totals = per_key.agg(
        F.sum(surplus).alias("surplus"), *[F.sum(n).alias(n) for n in nulls.values()]
    )
    found = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.coalesce(count, F.lit(0)).cast("bigint").alias("violations"),
        )
        for column, rule, count in (
            *[(c, NOT_NULL, n) for c, n in nulls.items()],
            (table.key, PRIMARY_KEY, "surplus"),
        )
    ]
    return totals.select(F.lit(table.name).alias("table_name"), F.inline(F.array(*found)))


def violations(tables: dict[str, DataFrame], layouts: dict[str, SourceTable]) -> DataFrame:
    """Broken constraints of all given tables; empty when every load may go ahead."""
    checks = [table_violations(rows, layouts[name]) for name, rows in tables.items()]
    return _stack(checks).filter("violations > 0")


def load_metrics(rows: DataFrame, table: SourceTable, batch_id: str, started, ended) -> DataFrame:
    """One log row for a load: row count, key problems, status and duration."""
    per_key = rows.groupBy(table.key).agg(F.count("*").alias("n"))
    is_null = F.col(table.key).isNull()
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(is_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~is_null, F.col("n") - 1)), F.lit(0)).alias("duplicate_keys"),
    )
    sound = (F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0)
    return counted.select(
        F.lit(table.name).alias("table_name"),
        F.lit(batch_id).alias("batch_id"),
        timestamp_lit(started).alias("load_start_time"),
        timestamp_lit(ended).alias("load_end_time"),
        "row_count",
        "null_keys",
        "duplicate_keys",
        F.when(sound, SUCCESS).otherwise(FAILED).alias("status"),
    )


def with_duration(log: DataFrame) -> DataFrame:
    """Second boundaries between start and end, derived when the log is read."""
    return log.withColumn(
        "duration_seconds", seconds_between(F.col("load_start_time"), F.col("load_end_time"))
    )


def latest_success(log: DataFrame, default: str = "INITIAL_LOAD") -> DataFrame:
    """Batch of the newest successful load, the default when there is none."""
    newest = F.max_by("batch_id", F.struct("load_end_time", "batch_id"))
    return log.filter(F.col("status") == SUCCESS).agg(
        F.coalesce(newest, F.lit(default)).alias("batch_id")
    )


def run_summary(log: DataFrame, batch: str, batch_column: str = "silver_batch_id") -> DataFrame:
    """What one batch did, table by table, in start order."""
    return (
        with_duration(log.filter(F.col(batch_column) == batch))
        .orderBy("load_start_time")
        .select(
            "table_name",
            "status",
            "rows_inserted",
            "rows_updated",
            F.col("duration_seconds").alias("duration_sec"),
            "error_message",
        )
    )

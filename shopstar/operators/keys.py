"""Dense running numbers without a single-task window over the rows.

A global `row_number` pulls the whole table into one task. Here rows are sorted by one range
exchange and stored as they come out of it; each stored row knows its task and its place in
it. What is left is a number per task: how many rows the tasks before it have. The numbers
equal `row_number() over (order by key)`, whatever the keys look like, and a plan that reads
them has neither an exchange nor a join for them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.sources.scratch import stored

Keep = Callable[[DataFrame], DataFrame]
# Fixed value: bits of monotonically_increasing_id() below the number of the task.
PLACE_BITS = 33


def running_start(group: list[str], order: str, count: str) -> Column:
    """Rows counted before this one within the group."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(before), F.lit(0).cast("bigint"))


def dense_identity(rows: DataFrame, name: str, keep: Keep = stored, first: Column | int = 1) -> DataFrame:
    """Add `name`: first, first + 1, ... in the order in which tasks produce the rows.

    `keep` stores the rows, since running them again could deal them out differently. The
    driver gets one count for each task of that write.
    """
    kept = keep(rows.withColumn("_id", F.monotonically_increasing_id()))
    task, place = F.shiftright("_id", PLACE_BITS), F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1)
    counted = kept.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows")).collect()
    counts = {r["_task"]: r["_rows"] for r in counted}
    starts = list(accumulate((counts.get(t, 0) for t in range(max(counts, default=0))), initial=0))
    start = F.element_at(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), (task + 1).cast("int"))
    base = first if isinstance(first, Column) else F.lit(first)
    return kept.withColumn(name, (base + start + place).cast("bigint")).drop("_id")


def assign_keys(rows: DataFrame, key: str, name: str, first: Column | int = 1, keep: Keep = stored) -> DataFrame:
    """Add `name`: first, first + 1, ... in order of the unique column `key`.

    A row without a key stays, without a number. All columns given are sorted and stored, so
    this belongs before joins that decorate them.
    """
    known = rows.filter(F.col(key).isNotNull())
    numbered = dense_identity(known.repartitionByRange(key).sortWithinPartitions(key), name, keep, first)
    if not rows.schema[key].nullable:
        return numbered
    return numbered.unionByName(rows.filter(F.col(key).isNull()).withColumn(name, F.lit(None).cast("bigint")))


def key_map(rows: DataFrame, key: str, name: str, first: Column | int = 1, keep: Keep = stored) -> DataFrame:
    """`key` and `name` alone, of the rows that have a key; numbers like `assign_keys`."""
    known = rows.select(key).filter(F.col(key).isNotNull())
    return dense_identity(known.repartitionByRange(key).sortWithinPartitions(key), name, keep, first)


def next_key(table: DataFrame, name: str) -> Column:
    """One above the largest key in use, 1 for an empty table (scalar subquery)."""
    return table.agg(F.coalesce(F.max(name), F.lit(0)) + 1).scalar()

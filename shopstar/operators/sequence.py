"""Numbering within groups of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.operators.keys import running_start


def number_in_group(
    rows: DataFrame,
    group: str,
    slot: Column,
    key: str,
    number: str,
    total: str,
    keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Add the position of each row in its group, by `slot` then `key`, and the group size.

    `key` is unique within the group. Equal to a window over the whole group, but rows are
    dealt out by range of (group, slot, key), so that a group of any size is cut into pieces
    no larger than a range. They are numbered within their piece and moved up by the
    group's rows in the ranges before, a count for each piece. `keep` stores the dealt rows,
    since cutting them anew could cut them elsewhere.
    """
    order = [slot.asc_nulls_first(), F.col(key)]
    dealt = rows.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id())
    dealt = keep(dealt)
    pieces = dealt.groupBy("_range", group).agg(F.count("*").alias("_rows"))
    starts = pieces.select(
        "_range",
        group,
        running_start([group], "_range", "_rows").alias("_start"),
        F.sum("_rows").over(Window.partitionBy(group)).alias(total),
    )
    position = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order))
    return (
        dealt.join(starts, ["_range", group])
        .withColumn(number, (position + F.col("_start")).cast("bigint"))
        .drop("_range", "_start")
    )

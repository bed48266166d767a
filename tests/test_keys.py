"""Numbering operators against plain windows, and plans without a single-task window."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from shopstar.operators.keys import assign_keys, dense_identity, key_map, next_key
from shopstar.operators.sequence import number_in_group
from shopstar.plans import dimensions
from shopstar.sources.scratch import stored


def test_keys_are_dense_over_sparse_and_negative_keys(spark):
    keys = random.Random(1).sample(range(-50_000, 5_000_000), 3_000)
    rows = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    got = assign_keys(rows, "k", "n").orderBy("n").collect()
    assert [(r.k, r.n) for r in got] == [(k, i + 1) for i, k in enumerate(sorted(keys))]
    shifted = assign_keys(rows, "k", "n", first=next_key(rows.selectExpr("7 AS s"), "s"))
    assert shifted.agg(F.min("n"), F.max("n")).first() == (8, 3_007)


def test_keys_of_the_whole_span(spark):
    """Hashed keys lie anywhere in a BIGINT, its ends included."""
    rng = random.Random(3)
    keys = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, *(rng.randrange(-(1 << 63), 1 << 63) for _ in range(2_000))]
    rows = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    got = assign_keys(rows, "k", "n").orderBy("n").collect()
    assert [(r.k, r.n) for r in got] == [(k, i + 1) for i, k in enumerate(sorted(keys))]


def test_keys_are_plain_columns_of_a_stored_table(spark):
    """No exchange, join or window is left for the plans that read a key map."""
    rows = spark.range(0, 30_000, 1, 7).select((F.col("id") * 7919 % 30_011 - 9_000).alias("k"))
    got = key_map(rows, "k", "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Join", "Window", "Sort"))
    found = [r.k for r in got.orderBy("n").collect()]
    assert found == sorted(found) and len(found) == 30_000
    assert got.agg(F.min("n"), F.max("n")).first() == (1, 30_000)
    assert key_map(rows.filter("k > 99999"), "k", "n").count() == 0


def test_keys_over_many_tasks(spark):
    """Tasks without rows, and one key range that holds nearly all rows."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = spark.createDataFrame([(k,) for k in [*range(25), -(1 << 62), 1 << 62]], "k BIGINT")
        got = key_map(rows, "k", "n", first=F.lit(100)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sorted((r.n, r.k) for r in got) == [(100 + i, k) for i, k in enumerate(sorted(r.k for r in got))]


def test_rows_without_a_key_stay(spark):
    rows = spark.createDataFrame([(5, "a"), (None, "b"), (-5, "c")], "k INT, v STRING")
    assert {r.v: r.n for r in assign_keys(rows, "k", "n").collect()} == {"a": 2, "b": None, "c": 1}


def test_next_key_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "s BIGINT")
    assert spark.range(1).select(next_key(empty, "s").alias("n")).first().n == 1


def _sessions(spark):
    """A third of the sessions belong to one customer, many of them to one minute."""
    rng = random.Random(2)
    rows = []
    for key in rng.sample(range(100_000), 3_000):
        customer = 1 if rng.random() < 0.34 else rng.randrange(2, 400)
        slot = rng.choice([None, 5, 5, 5, rng.randrange(1_000)])
        rows.append((customer, key, slot))
    return rows, spark.createDataFrame(rows, "c BIGINT, k BIGINT, s BIGINT")


def test_numbering_in_groups_of_any_size(spark):
    rows, frame = _sessions(spark)
    ordered = sorted(rows, key=lambda r: (r[0], -1 if r[2] is None else r[2], r[1]))
    expected, count = {}, {}
    for customer, key, _ in ordered:
        count[customer] = count.get(customer, 0) + 1
        expected[customer, key] = count[customer]
    got = number_in_group(frame, "c", F.col("s"), "k", "n", "total", stored)
    found = {(r.c, r.k): (r.n, r.total) for r in got.collect()}
    assert found == {ck: (n, count[ck[0]]) for ck, n in expected.items()}


def test_a_hot_group_is_numbered_in_pieces(spark):
    """The group holds a third of the rows; no piece is larger than a range of all rows."""
    _, frame = _sessions(spark)
    held = []

    def keep(rows):
        held.append(stored(rows))
        return held[0]

    partitions, adaptive = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {name: spark.conf.get(name) for name in (partitions, adaptive)}
    spark.conf.set(partitions, "16")
    spark.conf.set(adaptive, "false")
    try:
        assert number_in_group(frame, "c", F.col("s"), "k", "n", "total", keep).count() == 3_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    pieces = held[0].groupBy("_range", "c").count()
    assert pieces.filter("c = 1").count() >= 4
    assert pieces.agg(F.max("count")).first()[0] <= 2 * 3_000 / 16


def test_dense_identity_in_storage_order(spark):
    rows = spark.range(0, 1_000, 1, 7).filter("id % 3 = 0")
    got = dense_identity(rows, "n", stored).orderBy("id").collect()
    assert [r.n for r in got] == list(range(1, 335))
    assert dense_identity(rows.filter("id < 0"), "n", stored).count() == 0


def test_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 2922
    row = days.filter("date_key = 20240229").first()
    assert (row.quarter, row.month_name, row.day_of_week, row.day_name) == (1, "February", 5, "Thursday")
    minutes = dimensions.dim_time(spark)
    assert minutes.select("time_key").distinct().count() == 1440
    parts = {r.time_key: r.time_of_day for r in minutes.collect()}
    assert [parts[k] for k in (0, 559, 600, 1159, 1200, 1759, 1800, 2359)] == [
        "Noc", "Noc", "Rano", "Rano", "Popołudnie", "Popołudnie", "Wieczór", "Wieczór",
    ]
    empty = spark.createDataFrame([], "m TIMESTAMP_NTZ")
    assert dimensions.dim_date_covering(empty).count() == 0

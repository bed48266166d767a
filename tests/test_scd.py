"""Dimension maintenance over several batches."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopstar.operators import scd

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))
STAMPS = "source_created_at TIMESTAMP_NTZ, source_updated_at TIMESTAMP_NTZ"
PRODUCT = f"product_id BIGINT, {scd.PRODUCTS.attributes}, {STAMPS}"
CUSTOMER = f"customer_id BIGINT, {scd.CUSTOMERS.attributes}, {STAMPS}"


def products(spark, *rows, updated=None):
    """(id, name, price) triples."""
    money = lambda p: None if p is None else Decimal(p)
    full = [(i, n, "d", 1, 1, money(p), T1, updated) for i, n, p in rows]
    return spark.createDataFrame(full, PRODUCT)


def history(snapshot, key="product_id"):
    rows = [r.asDict() for r in snapshot.collect()]
    return sorted(rows, key=lambda r: (r[key], r["valid_from"]))


def run(spark, *batches):
    table = scd.empty(spark, scd.PRODUCTS)
    for moment, rows in zip((T1, T2, T3), batches, strict=False):
        table = scd.scd2_apply(table, rows, scd.PRODUCTS, f"B{moment.day}", moment)
    return history(table)


def test_new_changed_and_both(spark):
    rows = run(
        spark,
        products(spark, (1, "a", 10), (2, "b", 10), (3, "c", 10)),
        products(spark, (1, "a", 12), (2, "B", 10), (3, "C", 11), (4, "d", 1), updated=T2),
    )
    by_key = {k: [r for r in rows if r["product_id"] == k] for k in (1, 2, 3, 4)}
    old, new = by_key[1]
    assert (old["valid_to"], old["is_current"], old["product_skey"]) == (T2, False, 1)
    assert (new["valid_from"], new["valid_to"], new["is_current"]) == (T2, None, True)
    assert (new["product_skey"], new["dwh_batch_id"]) == (4, "B2")
    assert old["dwh_batch_id"] == "B1" and old["source_updated_at"] is None
    (kept,) = by_key[2]
    assert (kept["product_name"], kept["valid_from"], kept["product_skey"]) == ("B", T1, 2)
    assert (kept["dwh_batch_id"], kept["source_updated_at"]) == ("B2", T2)
    old, new = by_key[3]
    assert (old["product_name"], new["product_name"]) == ("c", "C")
    assert by_key[4][0]["product_skey"] == 6


def test_deleted_then_back(spark):
    rows = run(
        spark, products(spark, (1, "a", 1), (2, "b", 1)), products(spark, (2, "b", 1)),
        products(spark, (1, "a", 1), (2, "b", 1)),
    )
    first, second, other = rows
    assert (first["valid_to"], first["is_current"]) == (T2, False)
    assert (second["valid_from"], second["is_current"], second["product_skey"]) == (T3, True, 3)
    assert other["valid_to"] is None


def test_price_to_or_from_null_is_not_seen(spark):
    rows = run(
        spark,
        products(spark, (1, "a", None), (2, "b", 5)),
        products(spark, (1, "a", 5), (2, "b", None)),
    )
    assert [(r["product_id"], r["is_current"]) for r in rows] == [(1, True), (2, True)]
    assert rows[0]["list_price"] is None and rows[1]["list_price"] == 5


def test_same_batch_again_changes_nothing(spark):
    rows = products(spark, (1, "a", 10), (2, "b", None))
    assert run(spark, rows) == run(spark, rows, rows)


def test_empty_source_closes_everything(spark):
    rows = run(spark, products(spark, (1, "a", 10)), products(spark))
    assert [r["is_current"] for r in rows] == [False]


def test_customer_rules(spark):
    def people(*rows):
        full = [(i, n, "l", "e", b, "Inna", j, a, T1, None) for i, n, b, j, a in rows]
        return spark.createDataFrame(full, CUSTOMER)

    day = date(2024, 1, 1)
    first = people((1, "a", None, day, None), (2, "b", day, day, 5), (3, "c", day, day, 5))
    later = people((1, "a", None, day, 7), (2, "b", None, day, 5), (3, "c", day, date(2024, 2, 2), 5))
    table = scd.scd2_apply(scd.empty(spark, scd.CUSTOMERS), first, scd.CUSTOMERS, "B1", T1)
    kinds = scd.scd2_classify(table, later, scd.CUSTOMERS)
    assert {r.customer_id: r.change_type for r in kinds.collect()} == {
        1: scd.NEW_VERSION, 2: scd.OVERWRITE, 3: scd.UNCHANGED,
    }
    counts = scd.change_counts(table, later.filter("customer_id > 1"), scd.CUSTOMERS)
    assert {r.change_type: r["keys"] for r in counts.collect()} == {
        scd.CLOSED: 1, scd.OVERWRITE: 1, scd.UNCHANGED: 1,
    }
    rows = history(scd.scd2_apply(table, later, scd.CUSTOMERS, "B2", T2), "customer_id")
    assert rows[-1]["join_date"] == day


def small(spark, dim, *rows):
    ddl = f"{dim.key} BIGINT, {dim.attributes}, {STAMPS}"
    return spark.createDataFrame([(*r, T1, None) for r in rows], ddl)


def test_type1_triggers(spark):
    dim = scd.CATEGORIES
    first = small(spark, dim, (1, "a", None), (2, "b", None), (3, "", None), (4, "gone", None))
    later = small(spark, dim, (1, "a", 9), (2, "B", 9), (3, None, 9), (5, "new", None))
    table = scd.scd1_apply(scd.empty(spark, dim), first, dim, "B1", T1)
    rows = scd.scd1_apply(table, later, dim, "B2", T2).orderBy("category_id").collect()
    # A new parent alone is not noticed; a new name brings its parent along; '' is NULL.
    assert [(r.category_skey, r.category_name, r.parent_category_id, r.dwh_batch_id) for r in rows] \
        == [(1, "a", None, "B1"), (2, "B", 9, "B2"), (3, "", None, "B1"), (4, "gone", None, "B1"),
            (5, "new", None, "B2")]


def test_type1_ignores_activity_flag(spark):
    dim = scd.PAYMENT_METHODS
    table = scd.scd1_apply(scd.empty(spark, dim), small(spark, dim, (1, "a", True)), dim, "B1", T1)
    row = scd.scd1_apply(table, small(spark, dim, (1, "a", False)), dim, "B2", T2).first()
    assert (row.is_active, row.dwh_batch_id) == (True, "B1")


@pytest.mark.parametrize("collation, batch", [(None, "B2"), ("UTF8_LCASE", "B1")])
def test_case_blind_comparison_is_optional(spark, collation, batch):
    dim = scd.BRANDS
    table = scd.scd1_apply(scd.empty(spark, dim), small(spark, dim, (1, "Alfa")), dim, "B1", T1)
    row = scd.scd1_apply(table, small(spark, dim, (1, "ALFA")), dim, "B2", T2, collation).first()
    assert row.dwh_batch_id == batch


SOURCE = st.dictionaries(
    st.integers(1, 6), st.tuples(st.sampled_from("ab"), st.sampled_from([None, 1, 2])), max_size=6
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(SOURCE, min_size=2, max_size=3))
def test_history_invariants(spark, batches):
    """One current row per live key, no overlaps, unique and dense surrogate keys."""
    frames = [products(spark, *[(k, n, p) for k, (n, p) in b.items()]) for b in batches]
    rows = run(spark, *frames)
    current = [r["product_id"] for r in rows if r["is_current"]]
    assert sorted(current) == sorted(batches[-1])
    assert sorted(r["product_skey"] for r in rows) == list(range(1, len(rows) + 1))
    for before, after in zip(rows, rows[1:], strict=False):
        if before["product_id"] == after["product_id"]:
            assert before["valid_to"] is not None
            assert before["valid_to"] <= after["valid_from"]

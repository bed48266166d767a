"""Cleaning rules on NULL, blank, negative and future values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shopstar.operators import cleaning
from shopstar.schemas import SOURCES

NOW = datetime(2024, 6, 1, 12)


def raw(spark, table, *rows):
    """Rows given as dictionaries, every other column NULL."""
    schema = StructType([StructField(f.name, f.dataType) for f in SOURCES[table].schema])
    data = [tuple(r.get(name) for name in schema.fieldNames()) for r in rows]
    return spark.createDataFrame(data, schema)


def test_customers(spark):
    genders = ["Kobieta", "k", "K", "Mezczyzna", "m", "KOBIETA", None, "?"]
    rows = raw(spark, "customers", *[dict(customer_id=i, gender=g) for i, g in enumerate(genders)])
    got = [r.gender for r in cleaning.clean_customers(rows, NOW).orderBy("customer_id").collect()]
    assert got == ["Kobieta", "Kobieta", "Kobieta", "Mezczyzna", "Mezczyzna", "Inna", "Inna", "Inna"]
    blind = cleaning.clean_customers(rows, NOW, ignore_case=True).filter("customer_id = 5").first()
    assert blind.gender == "Kobieta"
    births = raw(
        spark,
        "customers",
        dict(customer_id=1, first_name=None, last_name=" ", date_of_birth=date(2024, 6, 2)),
        dict(customer_id=2, first_name=" aDAM ", last_name="\t", date_of_birth=date(2024, 6, 1)),
    )
    one, two = cleaning.clean_customers(births, NOW).orderBy("customer_id").collect()
    assert (one.first_name, one.last_name, one.date_of_birth) == ("N/A", "N/A", None)
    assert (two.first_name, two.last_name, two.date_of_birth) == ("Adam", "\t", date(2024, 6, 1))


def test_products_and_small_tables(spark):
    rows = raw(
        spark,
        "products",
        dict(product_id=1, name=None, description="a%b% ", list_price=Decimal("-1.50")),
        dict(product_id=2, name="  ", description=None, list_price=None),
    )
    one, two = cleaning.clean_products(rows).orderBy("product_id").collect()
    assert (one.product_name, one.description, one.list_price) == ("N/A", "a b", Decimal("1.50"))
    assert (two.product_name, two.description, two.list_price) == ("", "N/A", None)
    brands = raw(spark, "brands", dict(brand_id=1), dict(brand_id=2, name="  "))
    got = cleaning.clean_brands(brands).orderBy("brand_id").collect()
    assert [b.brand_name for b in got] == ["N/A", ""]
    methods = raw(spark, "payment_methods", dict(payment_method_id=1))
    assert cleaning.clean_payment_methods(methods).first().payment_method_name is None


def test_orders_and_items(spark):
    order = cleaning.clean_orders(
        raw(spark, "orders", dict(order_id=1, order_status=" new ", total_amount=Decimal("-5")))
    ).first()
    assert (order.order_status, order.total_amount, order.tax_amount) == ("NEW", 5, 0)
    items = raw(
        spark,
        "order_items",
        dict(order_item_id=1, quantity=-2, unit_price=Decimal("-3.00"), tax_amount=Decimal("0.50")),
        dict(order_item_id=2, quantity=None, unit_price=Decimal("3.00")),
    )
    one, two = cleaning.clean_order_items(items).orderBy("order_item_id").collect()
    assert (one.quantity, one.unit_price, one.line_total) == (-2, 3, Decimal("-5.50"))
    assert (two.quantity, two.discount_amount, two.line_total) == (None, 0, None)


def test_returns(spark):
    reasons = [None, "", " - ", "-", "ZA maly", "--"]
    rows = raw(
        spark,
        "order_item_returns",
        *[dict(return_id=i, reason=r, quantity_returned=-i) for i, r in enumerate(reasons)],
        dict(return_id=9, return_date=datetime(2024, 6, 1, 12, 0, 1)),
        dict(return_id=10, return_date=NOW),
    )
    got = cleaning.clean_returns(rows, NOW).orderBy("return_id").collect()
    assert [r.reason for r in got[:6]] == ["N/A", "N/A", "N/A", "N/A", "Za maly", "--"]
    assert (got[3].quantity_returned, got[6].quantity_returned) == (3, 0)
    assert (got[6].return_date, got[7].return_date) == (None, NOW)


def test_sessions_and_pageviews(spark):
    rows = raw(
        spark,
        "website_sessions",
        dict(website_session_id=1, created_at=NOW),
        dict(website_session_id=2, utm_source=" X ", utm_campaign=" Y", utm_content=" Zz ",
             device_type="MOBILE"),
    )
    one, two = cleaning.clean_sessions(rows).orderBy("website_session_id").collect()
    assert (one.utm_source, one.utm_campaign, one.utm_content, one.device_type) == (
        "direct", "organic_traffic", "organic", "N/A",
    )
    assert (one.session_start, one.source_created_at, one.source_updated_at) == (NOW, NOW, None)
    assert (two.utm_source, two.utm_campaign, two.utm_content, two.device_type) == (
        "x", "y", "Zz", "mobile",
    )
    views = raw(spark, "pageviews", dict(website_pageview_id=1, pageview_url=" /Home "))
    assert cleaning.clean_pageviews(views).select(F.col("pageview_url")).first()[0] == "/home"

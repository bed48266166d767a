"""Gold facts.

Attributes are looked up at the coarsest grain that determines them: the customer at
order or session grain and not per line or page view, so the largest table of each fact
is shuffled once for its parent and once more only for a key of its own. Returns are the
exception: fewer than orders, they look the customer up themselves. Every lookup joins a
unique key with the fact on the left, the form in which adaptive execution can split a
hot key over many tasks; no frame is hinted to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.functions import date_key, seconds_between, time_key
from shopstar.operators.cleaning import line_total
from shopstar.plans.dimensions import MONTH, UNKNOWN_KEY

UNKNOWN_PAYMENT = "Unknown"


def _member(column: str) -> Column:
    """The looked-up key, the unknown member where nothing was found."""
    return F.coalesce(column, F.lit(UNKNOWN_KEY)).alias(column)


def _customer_keys(dim_customers: DataFrame, business_key: str) -> DataFrame:
    return dim_customers.select(F.col("customer_id").alias(business_key), "customer_key")


def by_month(rows: DataFrame, date_key: str) -> DataFrame:
    """Adds year_month and deals the rows out by it; a crowded month is cut up again."""
    return rows.withColumn(MONTH, F.floor(F.col(date_key) / 100).cast("int")).hint("rebalance", MONTH)


def fact_sales(
    orders: DataFrame,
    order_items: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame | None,
    payment_methods: DataFrame | None,
) -> DataFrame:
    """Order lines. Without products or payment methods that column is left out.

    A report that reads neither saves the two joins; Spark cannot drop them itself as
    it does not know that their keys are unique.
    """
    placed = orders.join(_customer_keys(dim_customers, "customer_id"), "customer_id", "left")
    order_columns = [
        "order_id",
        F.col("session_id").alias("session_key"),
        _member("customer_key"),
        date_key(F.col("order_date")).alias("date_key"),
        time_key(F.col("order_date")).alias("time_key"),
    ]
    if payment_methods is not None:
        method = payment_methods.select("payment_method_id", "payment_method_name")
        placed = placed.join(method, "payment_method_id", "left")
        order_columns.append(
            F.coalesce("payment_method_name", F.lit(UNKNOWN_PAYMENT)).alias("payment_method")
        )
    placed = placed.select(*order_columns, "order_status")

    discount = F.coalesce("discount_amount", F.lit(0)).cast("decimal(18,2)")
    lines = order_items.select(
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        discount.alias("discount_amount"),
        "tax_amount",
        line_total(F.col("quantity"), F.col("unit_price"), F.col("tax_amount"), discount).alias(
            "total_amount"
        ),
    )
    sales = lines.join(placed, "order_id")
    product = []
    if dim_products is not None:
        sales = sales.join(dim_products.select("product_id", "product_key"), "product_id", "left")
        product = [_member("product_key")]
    return sales.select(*placed.columns, *product, *lines.columns[2:])


def pageview_stats(pageviews: DataFrame) -> DataFrame:
    """Views and duration per session; a busy session is combined before the shuffle."""
    seen = F.col("pageview_time")
    return pageviews.groupBy("website_session_id").agg(
        F.count("*").alias("total_pageviews"),
        seconds_between(F.min(seen), F.max(seen)).alias("duration_seconds"),
    )


def fact_sessions(
    sessions: DataFrame,
    pageviews: DataFrame,
    orders: DataFrame,
    dim_customers: DataFrame | None,
) -> DataFrame:
    """Sessions with activity and whether any order, of whatever status, came of them.

    Without customers that column is left out, as for sales.
    """
    bought = (
        orders.filter("session_id is not null")
        .select(F.col("session_id").alias("website_session_id"))
        .distinct()
        .withColumn("_bought", F.lit(True))
    )
    # Both right sides come out of their aggregation partitioned by session, so the
    # sessions are shuffled once for the two joins.
    visits = (
        sessions.select("website_session_id", "user_id", "session_start")
        .join(pageview_stats(pageviews), "website_session_id", "left")
        .join(bought, "website_session_id", "left")
    )
    customer = []
    if dim_customers is not None:
        visits = visits.join(_customer_keys(dim_customers, "user_id"), "user_id", "left")
        customer = [_member("customer_key")]
    return visits.select(
        F.col("website_session_id").alias("session_key"),
        *customer,
        date_key(F.col("session_start")).alias("start_date_key"),
        time_key(F.col("session_start")).alias("start_time_key"),
        F.coalesce("total_pageviews", F.lit(0)).alias("total_pageviews"),
        F.coalesce("duration_seconds", F.lit(0)).alias("duration_seconds"),
        F.coalesce("_bought", F.lit(False)).alias("resulted_in_sale"),
    )


MARKETING = ("utm_source", "utm_campaign", "utm_content", "device_type")


def fact_web_analytics(
    pageviews: DataFrame, sessions: DataFrame, dim_customers: DataFrame
) -> DataFrame:
    """Page views with the marketing attributes and customer of their session."""
    visits = sessions.join(_customer_keys(dim_customers, "user_id"), "user_id", "left").select(
        "website_session_id", "customer_key", *MARKETING
    )
    seen = F.col("pageview_time")
    return pageviews.join(visits, "website_session_id", "left").select(
        F.col("website_pageview_id").alias("pageview_id"),
        F.col("website_session_id").alias("session_key"),
        _member("customer_key"),
        date_key(seen).alias("date_key"),
        time_key(seen).alias("time_key"),
        F.col("pageview_url").alias("page_name"),
        *MARKETING,
    )


def page_visits(pageviews: DataFrame, sessions: DataFrame) -> DataFrame:
    """The distinct pages of each session with its marketing attributes.

    All that the marts read of the page view fact. Repeated views are dropped on the map
    side, so a session with a third of them does not reach the join as one group.
    """
    pages = pageviews.select("website_session_id", "pageview_url").distinct()
    return pages.join(
        sessions.select("website_session_id", *MARKETING), "website_session_id", "left"
    ).select(
        F.col("website_session_id").alias("session_key"),
        F.col("pageview_url").alias("page_name"),
        *MARKETING,
    )


def fact_returns(
    returns: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
) -> DataFrame:
    """Returned lines, traced over their order line and order to product and customer."""
    back = F.col("return_date")
    return (
        returns.join(
            order_items.select("order_item_id", "order_id", "product_id"), "order_item_id", "left"
        )
        .join(orders.select("order_id", "customer_id"), "order_id", "left")
        .join(_customer_keys(dim_customers, "customer_id"), "customer_id", "left")
        .join(dim_products.select("product_id", "product_key"), "product_id", "left")
        .select(
            "return_id",
            "order_item_id",
            "order_id",
            _member("customer_key"),
            _member("product_key"),
            date_key(back).alias("return_date_key"),
            time_key(back).alias("return_time_key"),
            F.col("reason").alias("return_reason"),
            "quantity_returned",
            "refund_amount",
        )
    )

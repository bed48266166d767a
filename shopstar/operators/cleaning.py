"""Cleaning projections from raw to silver columns.

Each is one narrow projection: no shuffle, and Spark prunes whatever a later step
does not read. The current moment is a parameter so that reruns give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.functions import (
    is_blank,
    magnitude,
    or_default,
    sentence_case,
    street_line,
    timestamp_lit,
)
from shopstar.functions.text import MISSING

# Gender labels, and the reasons that mean "none given".
WOMAN, MAN, OTHER = "Kobieta", "Mezczyzna", "Inna"
EMPTY_REASONS = ("", "-")


def _source_stamps() -> list[Column]:
    """Stamps of the source system, renamed so that they do not read as warehouse stamps."""
    return [
        F.col("created_at").alias("source_created_at"),
        F.col("updated_at").alias("source_updated_at"),
    ]


def _created_only() -> list[Column]:
    """Sessions and page views are never updated at the source."""
    return [
        F.col("created_at").alias("source_created_at"),
        F.lit(None).cast("timestamp_ntz").alias("source_updated_at"),
    ]


def _person_name(name: str) -> Column:
    return F.when(is_blank(F.col(name)), MISSING).otherwise(sentence_case(F.col(name))).alias(name)


def _gender(raw: Column, ignore_case: bool) -> Column:
    word = F.lower(raw) if ignore_case else raw
    code = F.upper(raw)
    return (
        F.when(word.endswith("obieta") | (code == "K"), WOMAN)
        .when(word.endswith("ezczyzna") | (code == "M"), MAN)
        .otherwise(OTHER)
    )


def _not_after(moment: str, today: Column) -> Column:
    """A date in the future is a typing error and is dropped."""
    value = F.col(moment)
    return F.when(value <= today, value).alias(moment)


def clean_customers(raw: DataFrame, as_of, ignore_case: bool = False) -> DataFrame:
    return raw.select(
        "customer_id",
        _person_name("first_name"),
        _person_name("last_name"),
        F.trim(F.lower("email")).alias("email"),
        _not_after("date_of_birth", timestamp_lit(as_of)),
        _gender(F.col("gender"), ignore_case).alias("gender"),
        "join_date",
        "address_id",
        *_source_stamps(),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    plain = F.trim(F.replace("description", F.lit("%"), F.lit(" ")))
    return raw.select(
        "product_id",
        or_default(F.trim("name")).alias("product_name"),
        or_default(plain).alias("description"),
        "category_id",
        "brand_id",
        F.abs("list_price").alias("list_price"),
        *_source_stamps(),
    )


def clean_addresses(raw: DataFrame, ignore_case: bool = False) -> DataFrame:
    return raw.select(
        "address_id",
        F.trim("country").alias("country"),
        sentence_case(F.col("city")).alias("city"),
        street_line(F.col("street"), ignore_case).alias("street"),
        F.replace(F.trim("postal_code"), F.lit(" "), F.lit("")).alias("postal_code"),
        *_source_stamps(),
    )


def clean_brands(raw: DataFrame) -> DataFrame:
    return raw.select("brand_id", or_default(F.trim("name")).alias("brand_name"), *_source_stamps())


def clean_categories(raw: DataFrame) -> DataFrame:
    return raw.select(
        "category_id",
        or_default(F.trim("name")).alias("category_name"),
        "parent_category_id",
        *_source_stamps(),
    )


def clean_payment_methods(raw: DataFrame) -> DataFrame:
    return raw.select(
        "payment_method_id",
        F.trim("payment_method_name").alias("payment_method_name"),
        "is_active",
        *_source_stamps(),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    amounts = ("subtotal", "discount", "tax", "shipping", "total")
    return raw.select(
        "order_id",
        "customer_id",
        "order_date",
        "payment_method_id",
        "session_id",
        F.upper(F.trim("order_status")).alias("order_status"),
        *[magnitude(F.col(f"{a}_amount")).alias(f"{a}_amount") for a in amounts],
        *_source_stamps(),
    )


def line_total(quantity: Column, price: Column, tax: Column, discount: Column) -> Column:
    return (quantity * price + tax - discount).cast("decimal(18,2)")


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Amounts become magnitudes; the quantity is taken as it comes, sign included."""
    money = {c: magnitude(F.col(c)) for c in ("unit_price", "discount_amount", "tax_amount")}
    total = line_total(
        F.col("quantity"), money["unit_price"], money["tax_amount"], money["discount_amount"]
    )
    return raw.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        *[amount.alias(name) for name, amount in money.items()],
        total.alias("line_total"),
        *_source_stamps(),
    )


def clean_returns(raw: DataFrame, as_of) -> DataFrame:
    no_reason = F.col("reason").isNull() | F.trim("reason").isin(*EMPTY_REASONS)
    return raw.select(
        "return_id",
        "order_item_id",
        _not_after("return_date", timestamp_lit(as_of)),
        F.coalesce(F.abs("quantity_returned"), F.lit(0)).alias("quantity_returned"),
        magnitude(F.col("refund_amount")).alias("refund_amount"),
        F.when(no_reason, MISSING).otherwise(sentence_case(F.col("reason"))).alias("reason"),
        *_source_stamps(),
    )


def clean_sessions(raw: DataFrame) -> DataFrame:
    tidy = lambda name: F.trim(F.lower(name))
    return raw.select(
        "website_session_id",
        F.col("created_at").alias("session_start"),
        "user_id",
        "is_repeat_session",
        or_default(tidy("utm_source"), "direct").alias("utm_source"),
        or_default(tidy("utm_campaign"), "organic_traffic").alias("utm_campaign"),
        or_default(F.trim("utm_content"), "organic").alias("utm_content"),
        or_default(tidy("device_type")).alias("device_type"),
        F.trim("http_referer").alias("http_referer"),
        *_created_only(),
    )


def clean_pageviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "website_pageview_id",
        F.col("created_at").alias("pageview_time"),
        "website_session_id",
        F.trim(F.lower("pageview_url")).alias("pageview_url"),
        *_created_only(),
    )

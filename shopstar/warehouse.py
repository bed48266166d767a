"""The whole warehouse over one folder of benchmark tables, built lazily.

Each property is the plan of a layer on top of the one below, so a query runs exactly the
part of the warehouse it reads. Only a dimension with several loads is stored in between.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.operators import cleaning, scd
from shopstar.plans import dimensions, facts, loads, marts
from shopstar.session import bytes_under, size_shuffles
from shopstar.sources.scratch import session_folder, stored
from shopstar.sources.snapshots import Lake
from shopstar.sources.tables import ShopTables, later_batch

# Load moments and batch ids; fixed so that every run gives the same rows.
LOADS = (
    ("SILVER_20250101_000000", "2025-01-01T00:00:00"),
    ("SILVER_20250201_000000", "2025-02-01T00:00:00"),
    ("SILVER_20250301_000000", "2025-03-01T00:00:00"),
)
AS_OF = LOADS[0][1]
# The calendar of the marts, long enough for the orders and events of the given tables.
CALENDAR = (date(1995, 1, 1), date(2030, 12, 31))

_CLEANERS = {
    "addresses": cleaning.clean_addresses,
    "brands": cleaning.clean_brands,
    "categories": cleaning.clean_categories,
    "customers": lambda raw: cleaning.clean_customers(raw, AS_OF),
    "payment_methods": cleaning.clean_payment_methods,
    "products": cleaning.clean_products,
    "orders": cleaning.clean_orders,
    "order_items": cleaning.clean_order_items,
    "order_item_returns": lambda raw: cleaning.clean_returns(raw, AS_OF),
    "website_sessions": cleaning.clean_sessions,
    "pageviews": cleaning.clean_pageviews,
}


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        size_shuffles(spark, bytes_under(spark, folder))
        self.raw = ShopTables(spark, folder)
        self._cleaned: dict[tuple[str, bool], DataFrame] = {}

    def cleaned(self, name: str, batch: int = 1) -> DataFrame:
        """Cleaned source rows; batch 2 is the changed source, other batches the first."""
        later = batch == 2
        if (name, later) not in self._cleaned:
            rows = self.raw.raw(name)
            self._cleaned[name, later] = _CLEANERS[name](later_batch(name, rows) if later else rows)
        return self._cleaned[name, later]

    def first_load(self, name: str) -> DataFrame:
        """Rows of a versioned dimension after the first load: every one is current.

        Stands for the stored snapshot where its surrogate keys and stamps are not read.
        """
        return self.cleaned(name).withColumn("is_current", F.lit(True))

    def snapshot(self, name: str, batches: int = 1) -> DataFrame:
        """Dimension after the first so many loads, each load reading a stored snapshot."""
        dim = scd.DIMENSIONS[name]
        apply = scd.scd2_apply if dim.versioned else scd.scd1_apply
        table = scd.empty(self.spark, dim)
        for batch, (batch_id, moment) in enumerate(LOADS[:batches], start=1):
            source = self.cleaned(name, batch)
            table = apply(stored(table) if batch > 1 else table, source, dim, batch_id, moment)
        return table

    def maintained(self, name: str, batches: int) -> DataFrame:
        """Dimension after the first so many loads into a lake, which runs them like any load."""
        lake = Lake(self.spark, session_folder(self.spark))
        for batch, (batch_id, moment) in enumerate(LOADS[:batches], start=1):
            loads.load_dimension(lake, name, self.cleaned(name, batch), batch_id, moment)
        return lake.read("silver", name)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, *CALENDAR)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(
            self.first_load("customers"), self.cleaned("addresses"), AS_OF, self.customer_keys
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(
            self.first_load("products"),
            self.cleaned("brands"),
            self.cleaned("categories"),
            self.product_keys,
        )

    @cached_property
    def customer_keys(self) -> DataFrame:
        return dimensions.customer_keys(self.first_load("customers"))

    @cached_property
    def product_keys(self) -> DataFrame:
        return dimensions.product_keys(self.first_load("products"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(
            self.cleaned("orders"),
            self.cleaned("order_items"),
            self.customer_keys,
            self.product_keys,
            self.cleaned("payment_methods"),
        )

    @cached_property
    def sales_for_marts(self) -> DataFrame:
        """Sales without the product and payment method, which no mart reads."""
        return facts.fact_sales(
            self.cleaned("orders"), self.cleaned("order_items"), self.customer_keys, None, None
        )

    @cached_property
    def fact_sessions(self) -> DataFrame:
        return facts.fact_sessions(
            self.cleaned("website_sessions"),
            self.cleaned("pageviews"),
            self.cleaned("orders"),
            self.customer_keys,
        )

    @cached_property
    def sessions_for_marts(self) -> DataFrame:
        """Sessions without their customer, for the marts that do not read it."""
        return facts.fact_sessions(
            self.cleaned("website_sessions"),
            self.cleaned("pageviews"),
            self.cleaned("orders"),
            None,
        )

    @cached_property
    def fact_web_analytics(self) -> DataFrame:
        return facts.fact_web_analytics(
            self.cleaned("pageviews"), self.cleaned("website_sessions"), self.customer_keys
        )

    @cached_property
    def page_visits(self) -> DataFrame:
        return facts.page_visits(self.cleaned("pageviews"), self.cleaned("website_sessions"))

    @cached_property
    def fact_returns(self) -> DataFrame:
        return facts.fact_returns(
            self.cleaned("order_item_returns"),
            self.cleaned("order_items"),
            self.cleaned("orders"),
            self.customer_keys,
            self.product_keys,
        )

    def mart_sales_summary(self) -> DataFrame:
        return marts.sales_summary(self.sales_for_marts, self.dim_date, None)

    def mart_campaign_summary(self) -> DataFrame:
        return marts.campaign_summary(
            self.sessions_for_marts, self.dim_date, self.page_visits, self.sales_for_marts
        )

    def mart_abandonment_rate(self) -> DataFrame:
        return marts.abandonment_rate(self.page_visits, self.sessions_for_marts)

    def mart_customer_summary(self) -> DataFrame:
        """The mart reads the sessions four times over, so they are built and stored once."""
        sessions = self.fact_sessions.drop("total_pageviews", "duration_seconds")
        return marts.customer_summary(
            stored(sessions), self.page_visits, self.dim_customers, self.sales_for_marts
        )

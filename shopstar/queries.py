"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    FloatType,
    IntegralType,
    TimestampNTZType,
)

from shopstar import functions as fn
from shopstar.operators import ingest, keys, quality, scd
from shopstar.operators.evolution import conform
from shopstar.plans import dimensions, facts, marts
from shopstar.schemas import SOURCES
from shopstar.session import tune
from shopstar.sources.scratch import session_folder, stored
from shopstar.sources.snapshots import Lake, numbered
from shopstar.warehouse import AS_OF, LOADS, Warehouse

Query = Callable[[SparkSession, str], DataFrame]
BATCH = "BATCH_20250101_000000"
QUERIES: dict[str, Query] = {}


def _plain(name: str, kind) -> Column:
    """One spelling per kind of value, the same in every SQL engine."""
    value = F.col(name)
    if isinstance(kind, BooleanType):
        return value.cast("int").cast("bigint")
    if isinstance(kind, IntegralType):
        return value.cast("bigint")
    if isinstance(kind, (DecimalType, FloatType)):
        return value.cast("double")
    if isinstance(kind, DateType):
        return value.cast("string")
    if isinstance(kind, TimestampNTZType):
        # Not date_format: it would go by way of the session time zone.
        text = value.cast("string")
        whole = F.length(text) == len("yyyy-MM-dd HH:mm:ss")
        return F.rpad(F.when(whole, F.concat(text, F.lit("."))).otherwise(text), 26, "0")
    return value


def present(rows: DataFrame) -> DataFrame:
    return rows.select(*[_plain(f.name, f.dataType).alias(f.name) for f in rows.schema])


def query(build: Callable[[Warehouse], DataFrame]) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(Warehouse(tune(spark), folder)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


# --- Ingest and load metrics ---------------------------------------------------------


def _customer_lines(w: Warehouse) -> DataFrame:
    """The raw customers as lines of a delimited file, some of them broken."""
    raw = w.raw.raw("customers")
    key = F.col("customer_id")
    iso, spaced = "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"

    def moment(column: str) -> Column:
        return F.when(key % 2 == 0, F.date_format(column, iso)).otherwise(
            F.date_format(column, spaced)
        )

    cells = [
        key.cast("string"),
        F.when(key % 10 == 3, F.concat(F.lit('"'), "first_name", F.lit('"'))).otherwise(
            F.col("first_name")
        ),
        F.col("last_name"),
        F.col("email"),
        F.when(key % 89 == 5, F.lit("31/12/1980")).otherwise(F.col("date_of_birth").cast("string")),
        F.col("gender"),
        F.col("join_date").cast("string"),
        F.col("address_id").cast("string"),
        moment("created_at"),
        moment("updated_at"),
        F.lit(""),
        F.when(key % 6 == 1, F.lit("EARLIER")).otherwise(F.lit("")),
    ]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])
    short = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells[:-1]])
    return raw.select(F.when(key % 83 == 7, short).otherwise(line).alias("line"))


@query
def bronze_ingest(w: Warehouse) -> DataFrame:
    """Delimited lines to typed, stamped rows; broken lines are left out."""
    table = SOURCES["customers"]
    text_rows = ingest.parse_lines(_customer_lines(w), "line", table)
    return ingest.stamp(ingest.accepted(ingest.type_cells(text_rows, table)), BATCH, AS_OF)


@query
def bronze_rejects(w: Warehouse) -> DataFrame:
    """Lines that do not fit the layout, with the columns at fault."""
    table = SOURCES["customers"]
    typed = ingest.type_cells(ingest.parse_lines(_customer_lines(w), "line", table), table)
    return ingest.rejected(typed).select(
        "customer_id", F.array_join("bad_columns", ",").alias("bad_columns")
    )


@query
def bronze_dq_violations(w: Warehouse) -> DataFrame:
    return quality.violations(w.raw.all(), SOURCES)


def _load_log(w: Warehouse) -> DataFrame:
    """One log row per raw table: loads start a minute apart."""
    logs = [
        quality.load_metrics(
            rows,
            SOURCES[name],
            BATCH,
            started=f"2025-01-01T00:{i:02d}:00",
            ended=f"2025-01-01T00:{i:02d}:{i * 5:02d}",
        )
        for i, (name, rows) in enumerate(w.raw.all().items())
    ]
    return reduce(DataFrame.unionByName, logs)


@query
def load_run_log(w: Warehouse) -> DataFrame:
    return quality.with_duration(_load_log(w))


@query
def latest_success_batch(w: Warehouse) -> DataFrame:
    """Newest good load, each month of orders being a load.

    A load fails when more than one order in eleven came without its tax.
    """
    untaxed = F.count(F.when(F.col("tax_amount").isNull(), 1))
    log = (
        w.raw.raw("orders")
        .groupBy(
            F.concat(F.lit("BATCH_"), F.date_format("order_date", "yyyyMM")).alias("batch_id")
        )
        .agg(
            F.max("order_date").alias("load_end_time"),
            F.when(untaxed * 11 > F.count("*"), quality.FAILED)
            .otherwise(quality.SUCCESS)
            .alias("status"),
        )
    )
    return quality.latest_success(log)


@query
def run_summary(w: Warehouse) -> DataFrame:
    log = _load_log(w).select(
        "table_name",
        F.lit(LOADS[0][0]).alias("silver_batch_id"),
        "load_start_time",
        "load_end_time",
        F.col("row_count").alias("rows_inserted"),
        F.lit(0).cast("bigint").alias("rows_updated"),
        "status",
        F.when(F.col("status") != quality.SUCCESS, F.lit("key constraint")).alias("error_message"),
    )
    return quality.run_summary(log, LOADS[0][0])


@query
def schema_evolution_union(w: Warehouse) -> DataFrame:
    """Sales stored before the discount column existed, next to those stored after."""
    sales = w.sales_for_marts.select(
        "order_id", "date_key", "quantity", "unit_price", "discount_amount", "total_amount"
    )
    return _evolved(stored(sales))


def _evolved(sales: DataFrame) -> DataFrame:
    """Sales of 1998 on as they are, earlier and undated ones under the layout before."""
    later = F.coalesce(F.col("date_key") >= 19980101, F.lit(False))
    older = sales.filter(~later).drop("discount_amount")
    return sales.filter(later).unionByName(conform(older, sales.schema))


# --- Silver --------------------------------------------------------------------------


@query
def silver_clean_customers(w: Warehouse) -> DataFrame:
    return w.cleaned("customers")


@query
def silver_clean_products(w: Warehouse) -> DataFrame:
    return w.cleaned("products")


@query
def silver_clean_addresses(w: Warehouse) -> DataFrame:
    return w.cleaned("addresses")


@query
def silver_clean_brands(w: Warehouse) -> DataFrame:
    return w.cleaned("brands")


@query
def silver_clean_categories(w: Warehouse) -> DataFrame:
    return w.cleaned("categories")


@query
def silver_clean_payment_methods(w: Warehouse) -> DataFrame:
    return w.cleaned("payment_methods")


@query
def silver_orders(w: Warehouse) -> DataFrame:
    return w.cleaned("orders")


@query
def silver_order_items(w: Warehouse) -> DataFrame:
    return w.cleaned("order_items")


@query
def silver_returns(w: Warehouse) -> DataFrame:
    return w.cleaned("order_item_returns")


@query
def silver_sessions(w: Warehouse) -> DataFrame:
    return w.cleaned("website_sessions")


@query
def silver_pageviews(w: Warehouse) -> DataFrame:
    return w.cleaned("pageviews")


# --- Dimension maintenance -----------------------------------------------------------


@query
def scd1_addresses(w: Warehouse) -> DataFrame:
    return w.snapshot("addresses", 2)


@query
def scd1_brands(w: Warehouse) -> DataFrame:
    return w.snapshot("brands", 2)


@query
def scd1_categories(w: Warehouse) -> DataFrame:
    return w.snapshot("categories", 2)


@query
def scd1_payment_methods(w: Warehouse) -> DataFrame:
    return w.snapshot("payment_methods", 2)


@query
def scd2_classify_customers(w: Warehouse) -> DataFrame:
    return scd.scd2_classify(w.first_load("customers"), w.cleaned("customers", 2), scd.CUSTOMERS)


@query
def scd2_classify_products(w: Warehouse) -> DataFrame:
    return scd.scd2_classify(w.first_load("products"), w.cleaned("products", 2), scd.PRODUCTS)


@query
def scd2_customers(w: Warehouse) -> DataFrame:
    """Customers after two loads."""
    return w.snapshot("customers", 2)


@query
def scd2_products(w: Warehouse) -> DataFrame:
    """Products after three loads; the third brings back what the second dropped."""
    return w.snapshot("products", 3)


@query
def scd2_products_in_folders(w: Warehouse) -> DataFrame:
    """Products after three loads, each of which stores what it changed and lists the rest."""
    return w.maintained("products", 3)


@query
def scd2_change_counts(w: Warehouse) -> DataFrame:
    counted = [
        scd.change_counts(w.first_load(d.name), w.cleaned(d.name, 2), d).select(
            F.lit(d.name).alias("table_name"), "change_type", "keys"
        )
        for d in (scd.CUSTOMERS, scd.PRODUCTS)
    ]
    return counted[0].unionByName(counted[1])


@query
def scd2_deleted_keys(w: Warehouse) -> DataFrame:
    gone = scd.deleted_keys(w.snapshot("products"), w.cleaned("products", 2), scd.PRODUCTS)
    return gone.select("product_skey", "product_id", "product_name", "valid_from")


@query
def surrogate_keys(w: Warehouse) -> DataFrame:
    """Dense keys for the sparse order numbers, in their order."""
    sparse = w.raw.raw("orders").select((F.col("order_id") * 7 + 13).alias("business_key"))
    return keys.key_map(sparse, "business_key", "surrogate_key")


# --- Expressions ---------------------------------------------------------------------


@query
def fn_sentence_case(w: Warehouse) -> DataFrame:
    return w.raw.raw("customers").select(
        "customer_id",
        fn.sentence_case(F.col("first_name")).alias("first_name"),
        fn.sentence_case(F.col("last_name")).alias("last_name"),
        fn.is_blank(F.col("first_name")).alias("blank"),
    )


@query
def fn_date_keys(w: Warehouse) -> DataFrame:
    seen = F.col("created_at")
    return w.raw.raw("pageviews").select(
        "website_pageview_id",
        fn.date_key(seen).alias("date_key"),
        fn.time_key(seen).alias("time_key"),
    )


@query
def fn_us_week(w: Warehouse) -> DataFrame:
    """Calendar attributes of every day on which something was ordered or shipped."""
    ordered = w.raw.given("orders").select(F.col("o_orderdate").cast("date").alias("day"))
    shipped = w.raw.given("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    day = F.col("day")
    return ordered.union(shipped).distinct().select(
        "day",
        fn.us_week(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


@query
def fn_age_bands(w: Warehouse) -> DataFrame:
    today, born = fn.timestamp_lit(AS_OF), F.col("date_of_birth")
    return w.cleaned("customers").select(
        "customer_id", fn.age(born, today).alias("age"), fn.age_band(born, today).alias("age_group")
    )


# --- Gold ----------------------------------------------------------------------------


@query
def dim_date(w: Warehouse) -> DataFrame:
    """The calendar years that the orders and page views span."""
    return dimensions.dim_date_covering(
        w.raw.raw("orders").select("order_date"), w.raw.raw("pageviews").select("created_at")
    )


@query
def dim_time(w: Warehouse) -> DataFrame:
    """The minutes of the day with the page views seen in each."""
    views = (
        w.raw.raw("pageviews")
        .groupBy(fn.time_key(F.col("created_at")).alias("time_key"))
        .agg(F.count("*").alias("pageviews"))
    )
    minutes = dimensions.dim_time(w.spark).join(views, "time_key", "left")
    return minutes.withColumn("pageviews", F.coalesce("pageviews", F.lit(0)))


@query
def dim_customers(w: Warehouse) -> DataFrame:
    return w.dim_customers


@query
def dim_products(w: Warehouse) -> DataFrame:
    return w.dim_products


@query
def fact_sales(w: Warehouse) -> DataFrame:
    return w.fact_sales


@query
def fact_sales_numbers(w: Warehouse) -> DataFrame:
    """Sales stored by month and numbered by their place: how many, and the numbers given."""
    place = Lake(w.spark, session_folder(w.spark))
    rows = facts.by_month(w.sales_for_marts, "date_key")
    location, counted = place.write("gold", "fact_sales", rows, by=dimensions.MONTH, numbered=True)
    found = numbered(w.spark, location, "sales_key")
    return found.agg(
        F.count("*").alias("sales"),
        F.min("sales_key").alias("first_key"),
        F.max("sales_key").alias("last_key"),
        F.countDistinct("sales_key").alias("different_keys"),
        F.sum("total_amount").alias("total_amount"),
    )


@query
def fact_sessions(w: Warehouse) -> DataFrame:
    return w.fact_sessions


@query
def fact_web_analytics(w: Warehouse) -> DataFrame:
    return w.fact_web_analytics


@query
def fact_returns(w: Warehouse) -> DataFrame:
    return w.fact_returns


@query
def session_pageview_stats(w: Warehouse) -> DataFrame:
    return facts.pageview_stats(w.cleaned("pageviews"))


@query
def session_attributes(w: Warehouse) -> DataFrame:
    return marts.session_attributes(w.page_visits, "utm_campaign", "device_type")


@query
def customer_session_sequence(w: Warehouse) -> DataFrame:
    return marts.customer_session_sequence(w.fact_sessions, stored)


# --- Marts ---------------------------------------------------------------------------


@query
def mart_sales_summary(w: Warehouse) -> DataFrame:
    return w.mart_sales_summary()


@query
def mart_sales_one_month(w: Warehouse) -> DataFrame:
    """The sales report of one month, over sales that have a folder for each month."""
    filed = stored(facts.by_month(w.sales_for_marts, "date_key"), by=dimensions.MONTH)
    return marts.sales_summary(filed, w.dim_date, None).filter("year = 1997 and month = 3")


@query
def mart_campaigns_one_month(w: Warehouse) -> DataFrame:
    """The campaigns of one month, over sessions that have a folder for each month."""
    filed = stored(facts.by_month(w.sessions_for_marts, "start_date_key"), by=dimensions.MONTH)
    report = marts.campaign_summary(filed, w.dim_date, w.page_visits, w.sales_for_marts)
    return report.filter("year = 2024 and month = 1")


@query
def mart_campaign_summary(w: Warehouse) -> DataFrame:
    return w.mart_campaign_summary()


@query
def mart_abandonment_rate(w: Warehouse) -> DataFrame:
    return w.mart_abandonment_rate()


@query
def mart_customer_summary(w: Warehouse) -> DataFrame:
    return w.mart_customer_summary()

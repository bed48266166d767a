"""Reporting marts over the star schema.

Each mart first reduces the facts to the grain its distinct counts need, then joins.
Counting after that needs no window, no fan-out to order lines, and every step before
a shuffle is combined on the map side, so a month, page, campaign or customer holding
a third of the rows arrives as partial results only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstar.functions import ratio
from shopstar.operators.sequence import number_in_group
from shopstar.plans.dimensions import MONTH, UNKNOWN_KEY


def session_attributes(web: DataFrame, *columns: str) -> DataFrame:
    """Marketing attributes once per session instead of once per page view."""
    return web.select("session_key", *columns).distinct()


def _dated(facts: DataFrame, dim_date: DataFrame, date_key: str, *columns: str) -> DataFrame:
    """Facts with columns of their day; those outside the calendar are left out.

    Stored facts have a folder for each month. Joined on the month as well, they are read
    only in the months that a filter on the calendar leaves (dynamic partition pruning).
    """
    month = [MONTH] if MONTH in facts.columns else []
    # In the calendar's own order: the pruning uses the join's broadcast only if both plans
    # are the same, and one of them would carry a projection that turns columns round.
    read = [c for c in dim_date.columns if c in ("date_key", *month, *columns)]
    days = dim_date.select(*read).withColumnRenamed("date_key", date_key)
    return facts.join(days, [date_key, *month])


def sales_summary(
    fact_sales: DataFrame, dim_date: DataFrame, dim_customers: DataFrame | None
) -> DataFrame:
    """Monthly sales. Sales outside the calendar are dropped; unknown customers count.

    An order's month and customer follow from the order. Without customers the sales are
    taken to be keyed by them already, as they are when built in one go.
    """
    month = ["year", "month", "month_name"]
    sums = {
        "total_revenue": "total_amount",
        "total_discounts": "discount_amount",
        "total_tax": "tax_amount",
        "total_units_sold": "quantity",
    }
    per_order = (
        _dated(fact_sales, dim_date, "date_key", *month)
        .groupBy(*month, "customer_key", "order_id")
        .agg(
            F.count("*").alias("num_line_items"),
            F.count("total_amount").alias("valued_lines"),
            *[F.sum(source).alias(name) for name, source in sums.items()],
        )
    )
    # Combined by customer first: then orders and customers are plain counts.
    added = ["num_line_items", *sums, "valued_lines"]
    per_customer = per_order.groupBy(*month, "customer_key").agg(
        F.count("*").alias("num_orders"), *[F.sum(name).alias(name) for name in added]
    )
    if dim_customers is not None:
        known = dim_customers.select("customer_key")
        per_customer = per_customer.join(known, "customer_key", "left_semi")
    return (
        per_customer.groupBy(*month)
        .agg(
            F.sum("num_orders").alias("num_orders"),
            F.sum("num_line_items").alias("num_line_items"),
            F.count("*").alias("unique_customers"),
            *[F.sum(name).alias(name) for name in (*sums, "valued_lines")],
        )
        .withColumn(
            "avg_order_line_value",
            F.col("total_revenue").cast("double") / F.nullif("valued_lines", F.lit(0)),
        )
        .drop("valued_lines")
    )


def campaign_summary(
    fact_sessions: DataFrame, dim_date: DataFrame, web: DataFrame, fact_sales: DataFrame
) -> DataFrame:
    """Orders, revenue and conversion per campaign and month of the session start.

    Sessions are counted before sales are attached. Sales reach their campaign over an
    inner join with the sales on the left, so a session holding many orders can be split.
    """
    cell = ["utm_campaign", "year", "month"]
    tagged = session_attributes(web.filter("utm_campaign is not null"), "utm_campaign")
    visits = (
        _dated(fact_sessions, dim_date, "start_date_key", "year", "month")
        .join(tagged, "session_key")
        .select("session_key", *cell)
    )
    sessions = visits.groupBy(*cell).agg(F.count("*").alias("total_sessions"))
    orders = (
        fact_sales.filter("session_key is not null")
        .groupBy("session_key", "order_id")
        .agg(F.sum("total_amount").alias("amount"))
    )
    sales = (
        orders.join(visits, "session_key")
        .groupBy(*cell)
        .agg(F.count("*").alias("num_orders"), F.sum("amount").alias("revenue"))
    )
    joined = sessions.join(sales, cell, "left").withColumn(
        "num_orders", F.coalesce("num_orders", F.lit(0))
    )
    return joined.select(
        *cell,
        "num_orders",
        "revenue",
        "total_sessions",
        ratio(F.col("num_orders"), F.col("total_sessions")).alias("conversion_rate"),
    )


def abandonment_rate(web: DataFrame, fact_sessions: DataFrame) -> DataFrame:
    """Share of a page's sessions that bought nothing, in percent.

    One row per page and session after the first step, so sessions are plain counts.
    """
    visits = web.filter("session_key is not null").select("page_name", "session_key").distinct()
    sold = F.col("resulted_in_sale")
    counted = (
        visits.join(fact_sessions.select("session_key", "resulted_in_sale"), "session_key")
        .groupBy("page_name")
        .agg(
            F.count("*").alias("sessions_visited"),
            F.count(F.when(sold, 1)).alias("sessions_converted"),
            F.count(F.when(~sold, 1)).alias("sessions_abandoned"),
        )
    )
    rate = ratio(F.col("sessions_abandoned"), F.col("sessions_visited"), scale=100)
    return counted.withColumn("abandonment_rate", rate)


def _customer_visits(fact_sessions: DataFrame) -> DataFrame:
    """Sessions of known customers with their place in time.

    `moment` orders the sessions of a customer in one fixed-width number, which Spark can
    aggregate in place: the minute, and behind it the session key, which settles ties that
    the calendar leaves open.
    """
    minute = F.coalesce("start_date_key", F.lit(0)).cast("bigint") * 10_000
    minute = (minute + F.coalesce("start_time_key", F.lit(0))).cast("decimal(18,0)")
    shifted = (minute * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)")
    return fact_sessions.filter(F.col("customer_key") != UNKNOWN_KEY).select(
        "customer_key",
        "session_key",
        "resulted_in_sale",
        (shifted + F.col("session_key").cast("decimal(19,0)")).cast("decimal(38,0)").alias("moment"),
    )


def _last_converting_campaign(visits: DataFrame, attributes: DataFrame) -> DataFrame:
    """The campaign last in the alphabet among a customer's converting sessions."""
    sold = visits.filter("resulted_in_sale").select("customer_key", "session_key")
    named = attributes.filter("utm_campaign is not null").select("session_key", "utm_campaign")
    seen = sold.join(named, "session_key").select("customer_key", "utm_campaign").distinct()
    last = Window.partitionBy("customer_key").orderBy(F.desc("utm_campaign"))
    return (
        seen.withColumn("_turn", F.row_number().over(last))
        .filter("_turn = 1")
        .select("customer_key", F.col("utm_campaign").alias("converting_campaign"))
    )


def customer_session_sequence(
    fact_sessions: DataFrame, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Running number and count of a known customer's sessions; `keep` stores a table."""
    known = fact_sessions.filter(F.col("customer_key") != UNKNOWN_KEY).select(
        "customer_key", "session_key", "start_date_key", "start_time_key"
    )
    minute = F.col("start_date_key").cast("bigint") * 10_000 + F.col("start_time_key")
    return number_in_group(
        known,
        "customer_key",
        minute,
        "session_key",
        number="session_number",
        total="total_sessions",
        keep=keep,
    )


def customer_summary(
    fact_sessions: DataFrame,
    web: DataFrame,
    dim_customers: DataFrame,
    fact_sales: DataFrame,
    per_line: bool = True,
) -> DataFrame:
    """Path to purchase and value per customer.

    `sessions_with_purchase` counts a converting session once per order line sold in it;
    with `per_line` off it counts each converting session once.

    Numbering every session is not needed: the first session is a minimum, and the number
    of the first converting one is how many sessions start no later than it.
    """
    visits = _customer_visits(fact_sessions)
    attributes = session_attributes(web, "utm_campaign", "device_type")
    sold = F.col("resulted_in_sale")
    per_customer = visits.groupBy("customer_key").agg(
        F.count("*").alias("total_sessions"),
        F.min("moment").alias("first_visit"),
        F.min_by("session_key", "moment").alias("first_session"),
        F.min(F.when(sold, F.col("moment"))).alias("first_sale"),
        F.count(F.when(sold, 1)).alias("converted"),
    )
    first = attributes.select(
        F.col("session_key").alias("first_session"),
        F.col("utm_campaign").alias("first_campaign"),
        F.col("device_type").alias("first_device"),
    )
    # An order has one session: orders per session are a count, sessions per customer too.
    per_session = (
        fact_sales.filter("session_key is not null")
        .groupBy("session_key", "order_id")
        .agg(F.count("*").alias("lines"), F.sum("total_amount").alias("amount"))
        .groupBy("session_key")
        .agg(
            F.count("*").alias("orders"),
            F.sum("lines").alias("lines"),
            F.sum("amount").alias("amount"),
        )
    )
    bought = (
        per_session.join(visits.drop("moment"), "session_key")
        .groupBy("customer_key")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("amount").alias("lifetime_value"),
            F.sum(F.when(sold, F.col("lines"))).alias("lines"),
            F.count(F.when(sold, 1)).alias("converted_with_lines"),
        )
    )
    # A converting session whose order has no lines still counts once.
    lines = F.coalesce("lines", F.lit(0)) - F.coalesce("converted_with_lines", F.lit(0))
    purchases = F.col("converted") + lines if per_line else F.col("converted")
    # Only customers who did not buy at once need their earlier sessions counted.
    later = per_customer.filter("first_sale > first_visit").select("customer_key", "first_sale")
    waited = (
        visits.select("customer_key", "moment")
        .join(later, "customer_key")
        .filter("moment <= first_sale")
        .groupBy("customer_key")
        .agg(F.count("*").alias("sessions_to_sale"))
    )
    first_purchase = F.when(
        F.col("first_sale").isNotNull(), F.coalesce("sessions_to_sale", F.lit(1))
    )
    person = dim_customers.select("customer_key", "full_name", "email", "country", "age_group")
    return (
        per_customer.join(bought, "customer_key", "left")
        .join(waited, "customer_key", "left")
        .join(_last_converting_campaign(visits, attributes), "customer_key", "left")
        .join(first, "first_session", "left")
        .join(person, "customer_key")
        .select(
            "customer_key",
            "full_name",
            "email",
            "country",
            "age_group",
            "total_sessions",
            "first_campaign",
            "first_device",
            "converting_campaign",
            purchases.alias("sessions_with_purchase"),
            first_purchase.cast("bigint").alias("first_purchase_session"),
            "lifetime_value",
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        )
    )

"""Gold dimensions. Each carries an unknown member under key -1 where facts need one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.functions import age, age_band, date_key, time_key, timestamp_lit, us_week
from shopstar.operators.keys import Keep, key_map
from shopstar.session import one_row
from shopstar.sources.scratch import stored

UNKNOWN_KEY = -1
# Year and month in one number; facts are filed by it.
MONTH = "year_month"
# Default calendar range, part-of-day labels with their last hour, and
# the texts of unknown members.
CALENDAR_START, CALENDAR_END = date(2023, 1, 1), date(2030, 12, 31)
DAY_PARTS = ((5, "Noc"), (11, "Rano"), (17, "Popołudnie"))
LAST_DAY_PART = "Wieczór"
UNKNOWN_PERSON, UNKNOWN_CITY = "Nieznany", "Nieznane"
UNKNOWN_PRODUCT, UNKNOWN_CATEGORY, UNKNOWN_BRAND = "Brak produktu", "Inne", "Nieznana Marka"


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Every day from `first_day` to `last_day` of a one-row frame, with its attributes."""
    day = F.col("full_date")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        (F.year(day) * 100 + F.month(day)).alias(MONTH),
        F.date_format(day, "MMMM").alias("month_name"),
        us_week(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    bounds = one_row(spark).select(
        F.lit(start.isoformat()).cast("date").alias("first_day"),
        F.lit(end.isoformat()).cast("date").alias("last_day"),
    )
    return calendar_days(bounds)


def dim_date_covering(*moments: DataFrame) -> DataFrame:
    """Whole years from the first to the last moment found in the given one-column frames."""
    spans = [
        m.agg(F.min(m.columns[0]).alias("lo"), F.max(m.columns[0]).alias("hi")) for m in moments
    ]
    span = spans[0]
    for other in spans[1:]:
        span = span.unionByName(other)
    last_year = F.trunc(F.max(F.col("hi").cast("date")), "YEAR")
    return calendar_days(
        span.agg(
            F.trunc(F.min(F.col("lo").cast("date")), "YEAR").alias("first_day"),
            F.date_sub(F.add_months(last_year, 12), 1).alias("last_day"),
        ).filter("first_day is not null")
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day."""
    hour, minute = F.col("hour_24"), F.col("minute")
    part = F
    for last_hour, label in DAY_PARTS:
        part = part.when(hour <= last_hour, label)
    minutes = spark.range(0, 24 * 60, 1, 1).select(
        F.floor(F.col("id") / 60).cast("int").alias("hour_24"),
        (F.col("id") % 60).cast("int").alias("minute"),
    )
    return minutes.select(
        (hour * 100 + minute).alias("time_key"),
        F.format_string("%02d:%02d", hour, minute).alias("time_24"),
        "hour_24",
        "minute",
        part.otherwise(LAST_DAY_PART).alias("time_of_day"),
    )


def _unknown_member(spark: SparkSession, like: DataFrame, **values) -> DataFrame:
    """One row shaped like the dimension, NULL where no value is given."""
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema]
    return one_row(spark).select(*columns)


def customer_keys(customers: DataFrame, keep: Keep = stored) -> DataFrame:
    """customer_id to customer_key, 1, 2, ... by id, of the current customers; stored.

    The unknown member is not among them: a fact gives its key to whatever is not found.
    """
    return key_map(customers.filter("is_current"), "customer_id", "customer_key", keep=keep)


def product_keys(products: DataFrame, keep: Keep = stored) -> DataFrame:
    """product_id to product_key, like the customers'."""
    return key_map(products.filter("is_current"), "product_id", "product_key", keep=keep)


def dim_customers(customers: DataFrame, addresses: DataFrame, as_of, numbers: DataFrame) -> DataFrame:
    """Current customers with address and age under the keys that `numbers` gives them."""
    today = timestamp_lit(as_of)
    born = F.col("date_of_birth")
    place = addresses.select("address_id", "city", "country")
    live = customers.filter("is_current")
    current = live.join(numbers, "customer_id").join(place, "address_id", "left")
    keyed = current.select(
        "customer_key",
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "gender",
        age(born, today).alias("age"),
        age_band(born, today).alias("age_group"),
        "city",
        "country",
        "join_date",
    )
    unknown = _unknown_member(
        customers.sparkSession,
        keyed,
        customer_key=UNKNOWN_KEY,
        customer_id=UNKNOWN_KEY,
        full_name=UNKNOWN_PERSON,
        city=UNKNOWN_CITY,
        country=UNKNOWN_PERSON,
    )
    return keyed.unionByName(unknown)


def dim_products(products: DataFrame, brands: DataFrame, categories: DataFrame, numbers: DataFrame) -> DataFrame:
    """Current products with brand, own category and the category one level up."""
    own = categories.select(
        "category_id", F.col("category_name").alias("own_name"), "parent_category_id"
    )
    parent = categories.select(
        F.col("category_id").alias("parent_category_id"),
        F.col("category_name").alias("parent_name"),
    )
    labelled = own.join(parent, "parent_category_id", "left").drop("parent_category_id")
    brand = brands.select("brand_id", F.col("brand_name").alias("own_brand"))
    live = products.filter("is_current")
    keyed = (
        live.join(numbers, "product_id")
        .join(brand, "brand_id", "left")
        .join(labelled, "category_id", "left")
        .select(
            "product_key",
            "product_id",
            "product_name",
            "description",
            F.coalesce("own_brand", F.lit(UNKNOWN_BRAND)).alias("brand_name"),
            F.coalesce("parent_name", F.lit(UNKNOWN_CATEGORY)).alias("category"),
            F.coalesce("own_name", F.lit(UNKNOWN_CATEGORY)).alias("subcategory"),
            "list_price",
        )
    )
    unknown = _unknown_member(
        products.sparkSession,
        keyed,
        product_key=UNKNOWN_KEY,
        product_id=UNKNOWN_KEY,
        product_name=UNKNOWN_PRODUCT,
        brand_name=UNKNOWN_BRAND,
        category=UNKNOWN_CATEGORY,
        subcategory=UNKNOWN_CATEGORY,
        list_price=0,
    )
    return keyed.unionByName(unknown)

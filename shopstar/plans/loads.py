"""The three layer loads, called one after the other by whatever schedules them.

Bronze and silver go on after a table fails; gold stops and raises. The run log of each
layer records what happened and which snapshot is valid.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.functions import timestamp_lit
from shopstar.operators import cleaning, ingest, quality, scd
from shopstar.operators.evolution import conform
from shopstar.operators.keys import next_key
from shopstar.operators.quality import FAILED, SUCCESS
from shopstar.plans import dimensions, facts, marts
from shopstar.schemas import SOURCES, SourceTable
from shopstar.session import bytes_under, size_shuffles, tune
from shopstar.sources import store
from shopstar.sources.files import read_delimited
from shopstar.sources.snapshots import Lake, Layer, now, read_parts

# What happens to lines that do not fit their layout, however many they are.
QUARANTINE, FAIL = "quarantine", "fail"
# Load orders, status words and the names of the reporting views.
BRONZE_ORDER = (
    "customers",
    "addresses",
    "brands",
    "categories",
    "products",
    "order_item_returns",
    "order_items",
    "orders",
    "pageviews",
    "payment_methods",
    "website_sessions",
)
SILVER_DIMENSIONS = (
    "addresses",
    "brands",
    "categories",
    "customers",
    "payment_methods",
    "products",
)
SILVER_FACTS = ("website_sessions", "pageviews", "orders", "order_items", "order_item_returns")
SKIPPED, GOLD_ERROR, GOLD_FAILURE = "Skipped", "Error", "ORCHESTRATOR FAILURE"
GOLD_ORDER = (
    "dim_date",
    "dim_time",
    "dim_customers",
    "dim_products",
    "fact_sessions",
    "fact_sales",
    "fact_web_analytics",
    "fact_returns",
)
# The running numbers of facts, and the date whose month each fact is filed under.
NUMBER_OF = {
    "fact_sales": "sales_key",
    "fact_web_analytics": "web_analytics_key",
    "fact_returns": "return_key",
}
MONTH_OF = {
    "fact_sessions": "start_date_key",
    "fact_sales": "date_key",
    "fact_web_analytics": "date_key",
    "fact_returns": "return_date_key",
}
SALES_VIEW, CAMPAIGN_VIEW = "vw_sales_summary", "vw_campaign_summary"
ABANDONMENT_VIEW, CUSTOMER_VIEW = "vw_abandonment_rate", "vw_customer_summary"


class LoadError(RuntimeError):
    """A load broke a constraint of its table; `found` goes to the log with it."""

    def __init__(self, message: str, found: dict):
        super().__init__(message)
        self.found = found


class NothingToLoad(RuntimeError):
    """The layer below has no valid rows for a table."""


def _message(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


# --- Bronze --------------------------------------------------------------------------


def load_bronze(
    spark: SparkSession,
    source: str,
    root: str,
    batch_id: str | None = None,
    as_of: datetime | None = None,
    on_malformed: str = QUARANTINE,
    tables: Collection[str] = BRONZE_ORDER,
) -> DataFrame:
    """Load `<source>/<table>.csv` for the raw tables; returns the log of the batch.

    Lines that do not fit the layout are set aside with the batch that met them, their
    number and place in the log; under "fail" any such line fails its table.
    """
    if on_malformed not in (QUARANTINE, FAIL):
        raise ValueError(f"on_malformed is {QUARANTINE!r} or {FAIL!r}, not {on_malformed!r}")
    lake = Lake(tune(spark), root)
    batch_id = batch_id or f"BATCH_{now():%Y%m%d_%H%M%S}"
    size_shuffles(spark, bytes_under(spark, *[f"{source}/{name}.csv" for name in tables]))
    for name in tables:
        started = now()
        try:
            text = read_delimited(spark, f"{source}/{name}.csv", SOURCES[name])
            outcome = _load_raw(
                lake, text, SOURCES[name], batch_id, as_of or started, on_malformed
            )
            outcome["status"] = SUCCESS
        except LoadError as error:
            outcome = dict(status=FAILED, error_message=_message(error), **error.found)
        except Exception as error:  # noqa: BLE001 - one table must not stop the others
            outcome = dict(status=FAILED, error_message=_message(error))
        ended = now()
        record = dict(
            table_name=name,
            batch_id=batch_id,
            load_start_time=started,
            load_end_time=ended,
            last_load_date=ended,
            created_at=ended,
        )
        lake.append_log("bronze", record | outcome)
    return lake.log("bronze").filter(F.col("batch_id") == batch_id)


def _load_raw(
    lake: Lake, text: DataFrame, table: SourceTable, batch_id: str, as_of, on_malformed: str
) -> dict:
    """Parse and store sound and broken lines in one pass, then check the constraints as stored."""
    typed = ingest.stamp(ingest.type_cells(text, table), batch_id, as_of)
    sound = F.col("accepted")
    counts = {"rows": F.count(F.when(sound, 1)), "broken": F.count(F.when(~sound, 1))}
    place, seen = lake.write("bronze", table.name, ingest.by_outcome(typed, batch_id), counts, by="accepted")
    found = {"rows_rejected": seen["broken"]}
    if seen["broken"]:
        found["rejected_location"] = f"{place}/accepted=false"
        if on_malformed == FAIL:
            raise LoadError(f"{seen['broken']} malformed lines", found)
    location = f"{place}/accepted=true"
    if not seen["rows"]:
        # No row, no folder: an empty file keeps the layout.
        ingest.accepted(typed).limit(0).write.parquet(location)
    rows = lake.spark.read.parquet(location)
    rules = quality.table_violations(rows, table).filter("violations > 0").collect()
    if rules:
        told = "; ".join(f"{b.rule} {b.column_name}: {b.violations}" for b in rules)
        raise LoadError(told, found)
    return dict(location=location, row_count=seen["rows"], **found)


# --- Silver --------------------------------------------------------------------------


def _cleaner(name: str, as_of, ignore_case: bool) -> Callable[[DataFrame], DataFrame]:
    cleaners = {
        "customers": lambda raw: cleaning.clean_customers(raw, as_of, ignore_case),
        "addresses": lambda raw: cleaning.clean_addresses(raw, ignore_case),
        "order_item_returns": lambda raw: cleaning.clean_returns(raw, as_of),
        "brands": cleaning.clean_brands,
        "categories": cleaning.clean_categories,
        "payment_methods": cleaning.clean_payment_methods,
        "products": cleaning.clean_products,
        "orders": cleaning.clean_orders,
        "order_items": cleaning.clean_order_items,
        "website_sessions": cleaning.clean_sessions,
        "pageviews": cleaning.clean_pageviews,
    }
    return cleaners[name]


def _changed(*kinds: str) -> Column:
    return F.count(F.when(F.col("_change").isin(*kinds), 1))


def _load_dimension(
    lake: Lake, name: str, silver: Layer, cleaned: DataFrame, batch_id, as_of, collation
) -> dict:
    dim = scd.DIMENSIONS[name]
    if dim.versioned:
        return _load_versions(lake, dim, silver, cleaned, batch_id, as_of, collation)
    target = _conformed(lake, dim, silver.get(name))
    with lake.scratch() as scratch:
        rows = scd.scd1_apply(target, cleaned, dim, batch_id, as_of, collation, True, scratch.keep)
        counts = {"rows_inserted": _changed(scd.INSERT, scd.OVERWRITE)}
        location, counted = lake.write("silver", name, rows, counts)
    return dict(location=location, scd_type="Type 1", **counted)


def load_dimension(lake: Lake, name: str, cleaned: DataFrame, batch_id: str, as_of, collation=None) -> dict:
    """Maintain one dimension of a lake with cleaned source rows, and log it."""
    started = now()
    outcome = _load_dimension(lake, name, lake.layer("silver"), cleaned, batch_id, as_of, collation)
    lake.append_log("silver", _silver_record(name, started, batch_id, None) | outcome | {"status": SUCCESS})
    return outcome


def _silver_record(name: str, started: datetime, batch_id: str, source_batch_id: str | None) -> dict:
    ended = now()
    return dict(
        table_name=name,
        source_layer="bronze",
        load_start_time=started,
        load_end_time=ended,
        silver_batch_id=batch_id,
        source_batch_id=source_batch_id,
        created_at=ended,
    )


def _conformed(lake: Lake, dim: scd.Dimension, rows: DataFrame | None) -> DataFrame:
    """A stored snapshot; under an older layout it has NULL in the columns added since."""
    return scd.empty(lake.spark, dim) if rows is None else conform(rows, dim.schema)


# Columns that part a versioned dimension into folders, and how many folders of closed versions
# a snapshot may list before small ones are written together.
CURRENT = "is_current"
CLOSED_FOLDERS = 16


def _load_versions(
    lake: Lake, dim: scd.Dimension, silver: Layer, cleaned: DataFrame, batch_id, as_of, collation
) -> dict:
    """Write current versions and those ended by this load; list the folders of older ones.

    Versions ended before are neither read nor written: their folders are only named again.
    """
    target = _conformed(lake, dim, silver.get(dim.name))
    top = silver.top_key(dim.name)
    first = next_key(target, dim.skey) if top is None else F.lit(top + 1)
    history = [f for f in silver.folders(dim.name) if f.endswith(f"/{CURRENT}=false")]
    counts = {
        "rows_inserted": _changed(scd.INSERT),
        "rows_updated": _changed(scd.NEW_VERSION),
        "rows_deleted": _changed(scd.CLOSED),
        "current": F.count(F.when(F.col(CURRENT), 1)),
        "top_key": F.max(dim.skey),
    }
    with lake.scratch() as scratch:
        rows = scd.scd2_next(
            scd.current_versions(target), cleaned, dim, batch_id, as_of, first, collation, scratch.keep
        )
        kept, joined = _compacted(lake, history)
        older = None
        if silver.folders(dim.name) and not _in_parts(silver, dim.name):
            # Written as one folder by an earlier layout of the lake.
            older = target.filter(f"not {CURRENT}")
        elif joined:
            older = _conformed(lake, dim, read_parts(lake.spark, joined))
        if older is not None:
            rows = rows.unionByName(older.withColumn("_change", F.lit(scd.UNCHANGED)))
        location, counted = lake.write("silver", dim.name, rows, counts, by=CURRENT)
    wrote = {value: f"{location}/{CURRENT}={value}" for value in ("true", "false")}
    parts = [path for path in wrote.values() if store.exists(lake.spark, path)] + kept
    if not parts:
        # A dimension without a single version: an empty file keeps the layout.
        scd.empty(lake.spark, dim).drop(CURRENT).write.parquet(wrote["true"])
        parts = [wrote["true"]]
    counted["top_key"] = max(counted["top_key"], top or 0)
    counted.pop("current")
    return dict(location=location, parts=parts, scd_type="Type 2", **counted)


def _in_parts(silver: Layer, name: str) -> bool:
    return any(f"/{CURRENT}=" in folder for folder in silver.folders(name))


def _compacted(lake: Lake, folders: list[str]) -> tuple[list[str], list[str]]:
    """Folders of closed versions, newest first: those to list on, and those to write together.

    Beyond CLOSED_FOLDERS the newest are joined, and with them each older one up to twice
    as large as all joined so far, so that a row is written anew only as its folder doubles.
    """
    if len(folders) < CLOSED_FOLDERS:
        return folders, []
    joined, size = folders[:2], bytes_under(lake.spark, *folders[:2])
    for folder in folders[2:]:
        more = bytes_under(lake.spark, folder)
        if more > 2 * size:
            break
        joined.append(folder)
        size += more
    return folders[len(joined) :], joined


def _load_fact_rows(lake: Lake, name: str, cleaned: DataFrame, batch_id, as_of) -> dict:
    skey = {"website_sessions": "website_session_skey", "order_item_returns": "return_skey"}.get(
        name, name.removesuffix("s") + "_skey"
    )
    rows = cleaned.withColumns(
        {"dwh_load_date": timestamp_lit(as_of), "dwh_batch_id": F.lit(batch_id)}
    )
    location, counted = lake.write("silver", name, rows, numbered=True)
    return dict(location=location, identity=skey, scd_type="Fact", rows_inserted=counted["rows"])


def load_silver(
    spark: SparkSession,
    root: str,
    silver_batch_id: str | None = None,
    source_batch_id: str | None = None,
    as_of: datetime | None = None,
    allow_empty_source: bool = False,
    collation: str | None = None,
    tables: Collection[str] = (*SILVER_DIMENSIONS, *SILVER_FACTS),
) -> DataFrame:
    """Clean the raw tables into silver; returns the summary of the batch.

    A table whose last raw load failed is skipped, and so is a versioned dimension whose
    source has no rows, since that would close every version; `allow_empty_source` lets
    an empty source through. `collation` (say UTF8_LCASE) makes cleaning and comparison of
    text attributes blind to case.
    """
    lake = Lake(tune(spark), root)
    as_of = as_of or now()
    batch_id = silver_batch_id or f"SILVER_{now():%Y%m%d_%H%M%S}"
    source_batch_id = source_batch_id or quality.latest_success(lake.log("bronze")).first()[0]
    bronze, silver = lake.layer("bronze"), lake.layer("silver")
    size_shuffles(spark, bytes_under(spark, *bronze.locations()))
    for name in tables:
        started = now()
        try:
            if bronze.status(name) != SUCCESS:
                raise NothingToLoad("last raw load did not succeed")
            raw = bronze[name]
            is_versioned = name in scd.DIMENSIONS and scd.DIMENSIONS[name].versioned
            if is_versioned and not allow_empty_source and raw.isEmpty():
                raise NothingToLoad("the source has no rows")
            cleaned = _cleaner(name, as_of, ignore_case=collation is not None)(raw)
            if name in scd.DIMENSIONS:
                outcome = _load_dimension(
                    lake, name, silver, cleaned, batch_id, as_of, collation
                )
            else:
                outcome = _load_fact_rows(lake, name, cleaned, batch_id, as_of)
            outcome["status"] = SUCCESS
        except NothingToLoad as reason:
            outcome = dict(status=SKIPPED, error_message=str(reason))
        except Exception as error:  # noqa: BLE001 - one table must not stop the others
            outcome = dict(status=FAILED, error_message=_message(error))
        lake.append_log("silver", _silver_record(name, started, batch_id, source_batch_id) | outcome)
    return quality.run_summary(lake.log("silver"), batch_id)


# --- Gold ----------------------------------------------------------------------------


def _gold_builders(
    spark: SparkSession, silver: Layer, fresh: dict[str, str], as_of, calendar, keep
) -> dict[str, Callable[[], DataFrame]]:
    """Tables in load order; facts read the dimensions written just before them."""
    gold = lambda name: spark.read.parquet(fresh[name])
    loaded = lambda rows: rows.withColumn("dwh_load_date", timestamp_lit(as_of))
    return {
        "dim_date": lambda: dimensions.dim_date(spark, *calendar),
        "dim_time": lambda: dimensions.dim_time(spark),
        "dim_customers": lambda: loaded(
            dimensions.dim_customers(
                silver["customers"],
                silver["addresses"],
                as_of,
                dimensions.customer_keys(silver["customers"], keep),
            )
        ),
        "dim_products": lambda: loaded(
            dimensions.dim_products(
                silver["products"],
                silver["brands"],
                silver["categories"],
                dimensions.product_keys(silver["products"], keep),
            )
        ),
        "fact_sessions": lambda: loaded(
            facts.fact_sessions(
                silver.bare("website_sessions"),
                silver.bare("pageviews"),
                silver.bare("orders"),
                gold("dim_customers"),
            )
        ),
        "fact_sales": lambda: loaded(
            facts.fact_sales(
                silver.bare("orders"),
                silver.bare("order_items"),
                gold("dim_customers"),
                gold("dim_products"),
                silver["payment_methods"],
            )
        ),
        "fact_web_analytics": lambda: loaded(
            facts.fact_web_analytics(
                silver.bare("pageviews"), silver.bare("website_sessions"), gold("dim_customers")
            )
        ),
        "fact_returns": lambda: loaded(
            facts.fact_returns(
                silver.bare("order_item_returns"),
                silver.bare("order_items"),
                silver.bare("orders"),
                gold("dim_customers"),
                gold("dim_products"),
            )
        ),
    }


def load_gold(
    spark: SparkSession,
    root: str,
    as_of: datetime | None = None,
    calendar: tuple[date, date] = (dimensions.CALENDAR_START, dimensions.CALENDAR_END),
) -> None:
    """Rebuild dimensions and facts from silver; the first failure ends the load.

    Dimension keys start over on every rebuild, so the tables become valid together: a
    load that fails half-way leaves the star schema of the load before in place. Facts
    have a folder for each month; a report that restricts the calendar reads no other.
    They are written once: their running numbers follow from the place of the rows.
    """
    lake = Lake(tune(spark), root)
    as_of = as_of or now()
    began = now()
    fresh: dict[str, str] = {}
    records = []
    try:
        silver = lake.layer("silver")
        size_shuffles(spark, bytes_under(spark, *silver.locations()))
        for name in GOLD_ORDER:
            started = now()
            try:
                with lake.scratch() as scratch:
                    builders = _gold_builders(spark, silver, fresh, as_of, calendar, scratch.keep)
                    rows, month = builders[name](), MONTH_OF.get(name)
                    if month:
                        rows = facts.by_month(rows, month)
                    fresh[name], counted = lake.write(
                        "gold", name, rows, by=dimensions.MONTH if month else None, numbered=name in NUMBER_OF
                    )
            except Exception as error:
                lake.append_log("gold", _gold_record(name, started, error=error))
                raise
            records.append(_gold_record(name, started, counted["rows"], fresh[name]))
        lake.append_log("gold", *records)
    except Exception as error:
        lake.append_log("gold", _gold_record(GOLD_FAILURE, began, error=error))
        raise


def _gold_record(name: str, started, rows: int = 0, location=None, error=None) -> dict:
    return dict(
        table_name=name,
        source_layer="silver",
        load_start_time=started,
        load_end_time=now(),
        rows_inserted=rows,
        location=location,
        identity=NUMBER_OF.get(name),
        status=GOLD_ERROR if error else SUCCESS,
        error_message=_message(error) if error else None,
    )


def register_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four reporting views over the stored star schema, by name."""
    gold = Lake(tune(spark), root).layer("gold")
    sales, sessions, web = (gold.bare(f) for f in ("fact_sales", "fact_sessions", "fact_web_analytics"))
    people, days = gold["dim_customers"], gold["dim_date"]
    views = {
        SALES_VIEW: marts.sales_summary(sales, days, people),
        CAMPAIGN_VIEW: marts.campaign_summary(sessions, days, web, sales),
        ABANDONMENT_VIEW: marts.abandonment_rate(web, sessions),
        CUSTOMER_VIEW: marts.customer_summary(sessions, web, people, sales),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return views

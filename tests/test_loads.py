"""The three layer loads over delimited files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopstar.plans.loads import load_bronze, load_gold, load_silver, register_marts
from shopstar.sources.snapshots import Lake
from tests.shop_files import ADDRESSES, CUSTOMERS, ORDERS, PRODUCTS, write_shop

DAY1, DAY2, DAY3 = (datetime(2024, 5, d) for d in (1, 2, 3))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """One full load of the small shop."""
    base = tmp_path_factory.mktemp("shop")
    source, root = write_shop(base / "in"), str(base / "lake")
    load_bronze(spark, source, root, "B1", DAY1)
    summary = load_silver(spark, root, "S1", as_of=DAY1).collect()
    load_gold(spark, root, DAY1)
    return Lake(spark, root), summary


def by(rows, key):
    return {r[key]: r for r in rows.collect()}


def test_bronze_is_typed_stamped_and_logged(loaded):
    lake, _ = loaded
    log = by(lake.log("bronze"), "table_name")
    assert {r.status for r in log.values()} == {"Success"}
    assert log["order_items"].row_count == 5
    rows = by(lake.read("bronze", "customers"), "customer_id")
    assert rows[3].last_name == '"Wrona'
    assert rows[3].date_of_birth is None and rows[3].address_id is None
    assert rows[1].created_at == datetime(2022, 5, 4, 7, 15, 30)
    assert rows[1].batch_id == "B1" and rows[1].load_date == DAY1


def test_silver_summary_and_rows(loaded):
    lake, summary = loaded
    assert [r.table_name for r in summary][:2] == ["addresses", "brands"]
    assert {r.status for r in summary} == {"Success"}
    assert {r.table_name: r.rows_inserted for r in summary}["customers"] == 3
    assert {r.source_batch_id for r in lake.log("silver").collect()} == {"B1"}
    people = by(lake.read("silver", "customers"), "customer_id")
    assert (people[1].first_name, people[1].email) == ("Irena", "irena@mail.pl")
    assert (people[2].first_name, people[2].gender) == ("Olek", "Mezczyzna")
    assert people[2].date_of_birth is None
    assert (people[3].first_name, people[3].gender) == ("N/A", "Kobieta")
    assert sorted(p.customer_skey for p in people.values()) == [1, 2, 3]
    assert lake.read("silver", "orders").select("order_skey").distinct().count() == 4


def test_gold_star_and_unknown_members(loaded):
    lake, _ = loaded
    sales = by(lake.read("gold", "fact_sales"), "product_key")
    assert len(sales) == 4  # the item without an order is gone
    assert sales[-1].payment_method == "Unknown"
    lines = lake.read("gold", "fact_sales").filter("order_id = 502").first()
    assert lines.customer_key == -1 and lines.session_key == 902
    first = lake.read("gold", "fact_sales").filter("order_id = 500 and quantity = 2").first()
    assert (first.date_key, first.time_key) == (20240305, 805)
    assert float(first.total_amount) == 19.5
    goods = by(lake.read("gold", "dim_products"), "product_id")
    assert (goods[100].category, goods[100].subcategory) == ("Karma", "Sucha")
    assert (goods[101].category, goods[101].brand_name) == ("Inne", "Nieznana Marka")
    back = by(lake.read("gold", "fact_returns"), "return_id")
    assert (back[3].order_id, back[3].product_key, back[3].customer_key) == (None, -1, -1)
    assert back[2].return_date_key is None and back[2].return_reason == "Za duzy"
    visits = by(lake.read("gold", "fact_sessions"), "session_key")
    assert visits[899].duration_seconds == 59 and not visits[899].resulted_in_sale
    assert visits[902].customer_key == -1 and visits[902].resulted_in_sale
    assert lake.read("gold", "dim_date").count() == 2922
    assert lake.read("gold", "dim_time").count() == 1440


def test_views(loaded, spark):
    lake, _ = loaded
    register_marts(spark, lake.root)
    months = spark.sql("select * from vw_sales_summary order by month").collect()
    assert [(m.month_name, m.num_orders, m.num_line_items) for m in months] == [
        ("March", 2, 3),
        ("April", 1, 1),
    ]
    assert float(months[0].total_revenue) == 19.5 + 20.5 + 15.1
    irena = spark.sql("select * from vw_customer_summary where full_name like 'Irena%'").first()
    # Order 503 has no lines: its session still counts once, session 900 once per line.
    assert irena.total_sessions == 3 and irena.sessions_with_purchase == 3
    assert irena.first_campaign == "spring" and irena.first_purchase_session == 2
    assert float(irena.lifetime_value) == 40.0 and irena.total_orders == 1
    pages = spark.sql("select * from vw_abandonment_rate").collect()
    home = {p.page_name: p for p in pages}["/home"]
    assert (home.sessions_visited, home.sessions_abandoned) == (4, 1)
    assert home.abandonment_rate == 25.0
    spring = spark.sql("select * from vw_campaign_summary where utm_campaign = 'summer'")
    assert [(r.month, r.num_orders, r.total_sessions) for r in spring.orderBy("month").collect()] \
        == [(3, 1, 1), (4, 0, 1)]


def test_same_batch_again_changes_nothing(spark, tmp_path):
    source, root = write_shop(tmp_path / "in"), str(tmp_path / "lake")
    lake = Lake(spark, root)
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1)
    before = {n: sorted(map(str, lake.read("silver", n).collect())) for n in ("customers", "brands")}
    load_bronze(spark, source, root, "B1", DAY2)
    summary = by(load_silver(spark, root, "S2", as_of=DAY2), "table_name")
    assert summary["customers"].rows_inserted == 0 and summary["customers"].rows_updated == 0
    after = {n: sorted(map(str, lake.read("silver", n).collect())) for n in ("customers", "brands")}
    assert before == after


def test_failures_are_isolated_and_old_rows_stay(spark, tmp_path):
    source, root = write_shop(tmp_path / "in"), str(tmp_path / "lake")
    lake = Lake(spark, root)
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1)
    twice = CUSTOMERS + CUSTOMERS.splitlines()[1] + "\n"
    empty = PRODUCTS.splitlines()[0] + "\n"
    broken = write_shop(
        tmp_path / "in2", customers=twice, products=empty, orders=ORDERS + "x,1\n", brands=None
    )
    log = by(load_bronze(spark, broken, root, "B2", DAY2, on_malformed="fail"), "table_name")
    assert "PRIMARY KEY customer_id: 1" in log["customers"].error_message
    assert "1 malformed lines" in log["orders"].error_message
    assert {n for n, r in log.items() if r.status == "Failed"} == {"customers", "orders", "brands"}
    summary = by(load_silver(spark, root, "S2", as_of=DAY2), "table_name")
    assert {n for n, r in summary.items() if r.status == "Skipped"} == {
        "customers", "orders", "brands", "products",
    }
    assert lake.read("silver", "products").filter("is_current").count() == 3
    load_silver(spark, root, "S3", as_of=DAY3, allow_empty_source=True)
    assert lake.read("silver", "products").filter("is_current").count() == 0


@pytest.mark.parametrize("bad", [0, 1, 10, 11, 1_000])
def test_malformed_lines_by_mode_and_not_by_number(spark, tmp_path, bad):
    text = ORDERS + "".join(f"x{i},1\n" for i in range(bad))
    source, root = write_shop(tmp_path / "in", orders=text), str(tmp_path / "lake")
    for mode, status in (("quarantine", "Success"), ("fail", "Failed" if bad else "Success")):
        log = by(
            load_bronze(spark, source, root, f"B_{mode}", DAY1, on_malformed=mode, tables=("orders",)),
            "table_name",
        )["orders"]
        assert (log.status, log.rows_rejected) == (status, bad)
        assert (log.rejected_location is None) == (bad == 0)
        if bad:
            aside = spark.read.parquet(log.rejected_location)
            assert aside.count() == bad
            assert {r.load_batch_id for r in aside.collect()} == {f"B_{mode}"}
        if status == "Success":
            assert log.row_count == 4
    assert not list((tmp_path / "lake").glob("_scratch/shopstar/*"))


def test_what_is_wrong_with_a_line(spark, tmp_path):
    long = "n" * 51
    text = ORDERS + f"505,1,2024-03-05T08:05:00,1,,{long},1,1,1,1,1,,,,\nx,1\n504,1,not a date,1,,new,1,1,1,1,1,,,,\n"
    source, root = write_shop(tmp_path / "in", orders=text), str(tmp_path / "lake")
    log = by(load_bronze(spark, source, root, "B1", DAY1), "table_name")
    assert (log["orders"].status, log["orders"].row_count) == ("Success", 4)
    aside = spark.read.parquet(log["orders"].rejected_location).collect()
    assert sorted(r.line or "" for r in aside) == ["", "", "x,1"]
    assert {tuple(r.bad_columns) for r in aside} == {
        ("order_status",), ("order_date",), ("order_id", "_corrupt"),
    }


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        load_bronze(spark, "in", str(tmp_path), on_malformed="ten")


def test_facts_agree_with_dimensions_and_lines(loaded):
    """Every key of a fact is a member of its dimension; sales sum up to the lines."""
    lake, _ = loaded
    gold = lake.layer("gold")
    keys = {
        "customer_key": gold["dim_customers"],
        "product_key": gold["dim_products"],
        "date_key": gold["dim_date"],
        "time_key": gold["dim_time"],
    }
    for fact, named in {
        "fact_sales": {k: k for k in keys},
        "fact_sessions": {
            "customer_key": "customer_key", "start_date_key": "date_key", "start_time_key": "time_key",
        },
        "fact_web_analytics": {k: k for k in keys if k != "product_key"},
        "fact_returns": {
            "customer_key": "customer_key", "product_key": "product_key",
            "return_date_key": "date_key", "return_time_key": "time_key",
        },
    }.items():
        for column, key in named.items():
            rows = gold[fact].filter(f"{column} is not null").select(F.col(column).alias(key))
            assert rows.join(keys[key], key, "left_anti").count() == 0, (fact, column)
    silver = lake.layer("silver")
    lines = silver["order_items"].join(silver["orders"].select("order_id"), "order_id")
    assert lines.agg(F.sum("line_total")).first() == gold["fact_sales"].agg(F.sum("total_amount")).first()


def test_facts_are_numbered_densely_and_filed_by_month(loaded):
    lake, _ = loaded
    gold, silver = lake.layer("gold"), lake.layer("silver")
    for rows, key in (
        (gold["fact_sales"], "sales_key"),
        (gold["fact_web_analytics"], "web_analytics_key"),
        (gold["fact_returns"], "return_key"),
        (silver["orders"], "order_skey"),
        (silver["order_items"], "order_item_skey"),
    ):
        numbers = sorted(r[0] for r in rows.select(key).collect())
        assert numbers == list(range(1, len(numbers) + 1))
    sales = gold["fact_sales"]
    assert sales.filter("year_month <> date_key div 100").count() == 0
    assert any("year_month=202403" in f for f in sales.inputFiles())


def test_case_blind_load(spark, tmp_path):
    shouted = CUSTOMERS.replace("Kobieta", "KOBIETA").replace("kobieta", "KOBIETA")
    streets = ADDRESSES.replace("ul.", "UL.")
    assert "KOBIETA" in shouted and "UL." in streets
    source, root = write_shop(tmp_path / "in", customers=shouted, addresses=streets), str(tmp_path / "lake")
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1, collation="UTF8_LCASE")
    lake = Lake(spark, root)
    blind = [r.street for r in lake.read("silver", "addresses").collect()]
    assert not [s for s in blind if "ul. ul." in s.lower()]
    people = by(lake.read("silver", "customers"), "customer_id")
    assert people[1].gender == "Kobieta"


def test_a_snapshot_of_an_older_layout_is_still_maintained(spark, tmp_path):
    source, root = write_shop(tmp_path / "in"), str(tmp_path / "lake")
    lake = Lake(spark, root)
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1, tables=("brands", "customers"))
    for name, column in (("brands", "brand_name"), ("customers", "gender")):
        location, _ = lake.write("silver", name, lake.read("silver", name).drop(column))
        moment = datetime(2100, 1, 1)
        lake.append_log("silver", dict(
            table_name=name, source_layer="bronze", load_start_time=moment, load_end_time=moment,
            silver_batch_id="OLD", status="Success", created_at=moment, location=location,
        ))
    before = lake.read("silver", "customers").count()
    summary = by(load_silver(spark, root, "S2", as_of=DAY2, tables=("brands", "customers")), "table_name")
    assert {r.status for r in summary.values()} == {"Success"}
    rows = [r for r in lake.log("silver").collect() if r.silver_batch_id == "S2" and r.table_name == "customers"]
    assert spark.read.parquet(rows[0].location).count() == before
    assert "gender" in spark.read.parquet(rows[0].location).columns


def test_gold_failure_is_logged_and_raised(spark, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(Exception):
        load_gold(spark, root, DAY1)
    log = by(Lake(spark, root).log("gold"), "table_name")
    assert log["dim_customers"].status == "Error"
    assert log["ORCHESTRATOR FAILURE"].status == "Error"
    assert "fact_sales" not in log

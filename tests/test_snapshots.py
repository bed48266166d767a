"""Stored snapshots: pruned months, listed folders, numbers by place, compacted logs, removal."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopstar.operators import scd
from shopstar.plans import loads
from shopstar.plans.loads import load_bronze, load_dimension, load_gold, load_silver, register_marts
from shopstar.schemas import LOGS
from shopstar.sources.runlog import RunLog
from shopstar.sources.scratch import Scratch
from shopstar.sources.snapshots import Lake, now, numbered
from tests.shop_files import CUSTOMERS, ORDER_ITEMS, ORDERS, PAGEVIEWS, SESSIONS, T, write_shop

DAY1, DAY2, DAY3 = (datetime(2024, 5, d) for d in (1, 2, 3))


def files(folder: str) -> dict[str, tuple[int, int]]:
    """Every data file below a folder, with its time of writing and size."""
    found = Path(folder).rglob("*.parquet")
    return {str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in found}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("shop")
    source, root = write_shop(base / "in"), str(base / "lake")
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1)
    load_gold(spark, root, DAY1)
    return Lake(spark, root)


# --- Months --------------------------------------------------------------------------


def busy_shop(folder):
    """Sessions, orders and lines of a year, enough to outweigh the calendar."""
    head = lambda text: text.splitlines()[0] + "\n"
    day = lambda i: f"2024-{i % 12 + 1:02d}-{i % 28 + 1:02d}T{i % 24:02d}:{i % 60:02d}:00"
    cents = lambda i: f"{i * 7919 % 99991 / 100:.2f}"
    many = range(1, 20_001)
    return write_shop(
        folder,
        website_sessions=head(SESSIONS) + "".join(f"{i},{day(i)},1,0,bing,c{i % 5},,desktop,,,\n" for i in many),
        pageviews=head(PAGEVIEWS) + "".join(f"{i},{day(i)},{i},/home,,\n" for i in many),
        orders=head(ORDERS) + "".join(f"{i},1,{day(i)},1,{i},paid,{cents(i)},,,,{cents(i)},{T},{T},,\n" for i in many),
        order_items=head(ORDER_ITEMS) + "".join(f"{i},{i},100,1,{cents(i)},{cents(i + 5)},,{T},{T},,\n" for i in many),
    )


@pytest.fixture(scope="module")
def busy(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("busy")
    source, root = busy_shop(base / "in"), str(base / "lake")
    load_bronze(spark, source, root, "B1", DAY1)
    load_silver(spark, root, "S1", as_of=DAY1)
    load_gold(spark, root, DAY1)
    return Lake(spark, root)


@pytest.mark.parametrize("view, fact", [("vw_sales_summary", "fact_sales"), ("vw_campaign_summary", "fact_sessions")])
def test_a_report_of_one_month_reads_one_folder(spark, busy, view, fact):
    """The other months' files are out of the way when the report runs: it cannot have read them."""
    register_marts(spark, busy.root)
    report = f"select * from {view} where year = 2024 and month = 3"
    want = spark.sql(report).collect()
    assert want
    again = spark.sql(report)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(year_month" in plan
    away = {}
    for file in Path(busy.root, "gold", fact).rglob("*.parquet"):
        if file.parent.name != "year_month=202403":
            away[file] = file.read_bytes()
            file.unlink()
    assert len({file.parent.name for file in away}) == 11
    try:
        assert sorted(map(str, again.collect())) == sorted(map(str, want))
    finally:
        for file, data in away.items():
            file.write_bytes(data)


def test_the_calendar_names_its_months(shop):
    days = shop.read("gold", "dim_date")
    assert days.filter("year_month <> date_key div 100").count() == 0


# --- Folders of closed versions ------------------------------------------------------


def brands(spark, rows):
    shape = "product_id BIGINT, product_name STRING, description STRING, category_id BIGINT, brand_id BIGINT, list_price DECIMAL(18,2), source_created_at TIMESTAMP_NTZ, source_updated_at TIMESTAMP_NTZ"
    return spark.createDataFrame([(k, n, "d", 1, 1, p, DAY1, None) for k, n, p in rows], shape)


def batch(spark, number):
    """Each batch changes the price of three products, drops one and brings one back."""
    from decimal import Decimal

    rows = []
    for key in range(1, 21):
        if key % 7 == number % 7:
            continue
        price = number if key % 6 == number % 6 else key
        rows.append((key, f"p{key}", Decimal(price)))
    return brands(spark, rows)


def test_closed_versions_stay_where_they_are(spark, tmp_path):
    """Later loads list their folders and neither read nor write them."""
    lake = Lake(spark, str(tmp_path / "lake"))
    plain = scd.empty(spark, scd.PRODUCTS)
    seen: dict[str, dict] = {}
    for number in range(1, 6):
        moment = DAY1 + timedelta(days=number)
        source = batch(spark, number)
        load_dimension(lake, "products", source, f"S{number}", moment)
        plain = scd.scd2_apply(plain, source, scd.PRODUCTS, f"S{number}", moment)
        layer = lake.layer("silver")
        for folder, before in seen.items():
            assert folder in layer.folders("products")
            assert files(folder) == before
        closed = [f for f in layer.folders("products") if f.endswith("is_current=false")]
        assert len(closed) == number - 1
        seen = {f: files(f) for f in closed}
        got, want = layer["products"], plain
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
        assert layer.top_key("products") == want.agg(F.max("product_skey")).first()[0]


def test_current_versions_are_read_without_the_closed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for number in (1, 2, 3):
        load_dimension(lake, "products", batch(spark, number), f"S{number}", DAY1 + timedelta(days=number))
    live = scd.current_versions(lake.read("silver", "products"))
    layer = lake.layer("silver")
    for folder in layer.folders("products"):
        if folder.endswith("is_current=false"):
            for file in Path(folder).glob("*.parquet"):
                file.unlink()
    assert live.count() == batch(spark, 3).count()


def test_small_folders_of_closed_versions_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "CLOSED_FOLDERS", 3)
    lake = Lake(spark, str(tmp_path / "lake"))
    plain = scd.empty(spark, scd.PRODUCTS)
    for number in range(1, 8):
        moment = DAY1 + timedelta(days=number)
        load_dimension(lake, "products", batch(spark, number), f"S{number}", moment)
        plain = scd.scd2_apply(plain, batch(spark, number), scd.PRODUCTS, f"S{number}", moment)
        layer = lake.layer("silver")
        assert len(layer.folders("products")) <= 1 + 3
    got = layer["products"].select(plain.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_a_dimension_without_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    load_dimension(lake, "products", batch(spark, 1).filter("false"), "S1", DAY1)
    assert lake.read("silver", "products").count() == 0
    load_dimension(lake, "products", batch(spark, 1), "S2", DAY2)
    load_dimension(lake, "products", batch(spark, 1).filter("false"), "S3", DAY3)
    rows = lake.read("silver", "products")
    assert rows.count() == batch(spark, 1).count() and rows.filter("is_current").count() == 0
    load_dimension(lake, "products", batch(spark, 1), "S4", DAY3)
    keys = sorted(r[0] for r in lake.read("silver", "products").select("product_skey").collect())
    assert keys == list(range(1, len(keys) + 1))


# --- One write, and numbers by place -------------------------------------------------


def test_facts_are_written_once(spark, shop, monkeypatch):
    """Neither a copy in scratch nor a second snapshot: a single write holds all rows."""
    kept = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, rows, by=None: kept.append(rows.columns) or keep(self, rows, by))
    load_silver(spark, shop.root, "S2", as_of=DAY2, tables=("orders", "order_items"))
    load_gold(spark, shop.root, DAY2)
    assert {tuple(c) for c in kept} <= {("customer_id", "_id"), ("product_id", "_id")}


def test_numbers_by_place(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(0, 5_000, 1, 9).filter("id % 7 <> 3").withColumn("part", F.col("id") % 4)
    for by in (None, "part"):
        location, counted = lake.write("gold", "t", rows, by=by, numbered=True)
        found = numbered(spark, location, "n").collect()
        assert sorted(r.n for r in found) == list(range(1, counted["rows"] + 1))
        assert {r.id for r in found} == {r.id for r in rows.collect()}
        again = numbered(spark, location, "n").filter("id > 4000").collect()
        assert {(r.id, r.n) for r in again} <= {(r.id, r.n) for r in found}
    location, counted = lake.write("gold", "t", rows.filter("id < 0").drop("part"), numbered=True)
    assert numbered(spark, location, "n").count() == 0


# --- Ingest --------------------------------------------------------------------------


def test_sound_and_broken_lines_are_stored_in_one_pass(spark, tmp_path, monkeypatch):
    wrote = []
    write = Lake.write
    monkeypatch.setattr(Lake, "write", lambda self, *a, **k: wrote.append(a[1]) or write(self, *a, **k))
    monkeypatch.setattr(Scratch, "keep", None)
    source, root = write_shop(tmp_path / "in", orders=ORDERS + "x,1\ny,2\n"), str(tmp_path / "lake")
    log = load_bronze(spark, source, root, "B1", DAY1, tables=("orders",)).first()
    assert wrote == ["orders"]
    assert (log.row_count, log.rows_rejected) == (4, 2)
    rows = Lake(spark, root).read("bronze", "orders")
    assert "line" not in rows.columns and "accepted" not in rows.columns and rows.count() == 4
    assert sorted(r.line for r in spark.read.parquet(log.rejected_location).collect()) == ["x,1", "y,2"]


@pytest.mark.parametrize("text", [ORDERS.splitlines()[0] + "\n", ORDERS.splitlines()[0] + "\nx,1\n"])
def test_no_sound_line(spark, tmp_path, text):
    source, root = write_shop(tmp_path / "in", orders=text), str(tmp_path / "lake")
    log = load_bronze(spark, source, root, "B1", DAY1, tables=("orders",)).first()
    assert (log.status, log.row_count) == ("Success", 0)
    rows = Lake(spark, root).read("bronze", "orders")
    assert rows.count() == 0 and "order_date" in rows.columns


# --- Run log -------------------------------------------------------------------------


def entry(spark, number):
    moment = DAY1 + timedelta(minutes=number)
    return dict(
        table_name=f"t{number % 7}", source_layer="silver", load_start_time=moment, load_end_time=moment,
        rows_inserted=number, status="Success", location=f"x{number}",
    )


def test_two_hundred_loads_leave_few_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), tail=20)
    for number in range(200):
        lake.append_log("gold", entry(spark, number))
    log = lake.log("gold")
    assert len(log.inputFiles()) <= 21
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) <= 2 * 21 + 4
    assert sorted(r.rows_inserted for r in log.collect()) == list(range(200))
    layer = lake.layer("gold")
    assert sorted(layer.folders(f"t{i}")[0] for i in range(7)) == sorted(f"x{n}" for n in range(193, 200))


def test_a_reader_keeps_its_rows_while_checkpoints_come(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), tail=4)
    for number in range(4):
        lake.append_log("gold", entry(spark, number))
    reader = lake.log("gold")
    lake.append_log("gold", entry(spark, 4))
    assert reader.count() == 4


def test_an_incomplete_checkpoint_does_not_count(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "gold" / "metadata"), LOGS["gold"], tail=100)
    lake = Lake(spark, str(tmp_path), tail=100)
    for number in range(3):
        lake.append_log("gold", entry(spark, number))
    log.rows().write.parquet(f"{tmp_path}/gold/metadata_checkpoints/000000000001-a/rows")
    assert lake.log("gold").count() == 3
    # A row that is appended while a checkpoint is written stays in the tail.
    state = log._state()
    lake.append_log("gold", entry(spark, 3))
    log._write_checkpoint(*state)
    assert sorted(r.rows_inserted for r in lake.log("gold").collect()) == [0, 1, 2, 3]


# --- Removal -------------------------------------------------------------------------


def test_vacuum_leaves_what_is_valid(spark, tmp_path):
    source, root = write_shop(tmp_path / "in", orders=ORDERS + "x,1\n"), str(tmp_path / "lake")
    lake = Lake(spark, root)
    changed = CUSTOMERS.replace(",1,2022", ",2,2022")
    other = write_shop(tmp_path / "in2", customers=changed)
    names = ("customers", "brands", "orders")
    for number, (files_, moment) in enumerate(((source, DAY1), (other, DAY2), (source, DAY3)), start=1):
        load_bronze(spark, files_, root, f"B{number}", moment)
        load_silver(spark, root, f"S{number}", as_of=moment, tables=names)
    before = {n: sorted(map(str, lake.read("silver", n).collect())) for n in names}
    assert lake.read("silver", "customers").count() == 5
    # A load that has written its rows and not yet its log row.
    running, _ = lake.write("silver", "brands", lake.read("silver", "brands"))
    reader = lake.read("bronze", "orders")
    assert lake.vacuum("silver", keep=3) == []
    long_ago = now() - timedelta(days=7)
    assert lake.vacuum("silver", keep=1, superseded_before=long_ago) == []
    gone = lake.vacuum("silver", keep=1)
    assert len([p for p in gone if "/brands/load=" in p]) == 2
    assert not any(Path(p).exists() for p in gone)
    assert Path(running).exists()
    assert {n: sorted(map(str, lake.read("silver", n).collect())) for n in names} == before
    # The closed versions of the second load are still where that load wrote them.
    assert any(p.endswith("is_current=true") for p in gone)
    assert lake.vacuum("silver", keep=1) == []
    lake.vacuum("bronze", keep=1)
    assert reader.count() == 4
    aside = [r.rejected_location for r in lake.log("bronze").collect() if r.rejected_location]
    assert len(aside) == 2 and all(spark.read.parquet(p).count() == 1 for p in aside)
    assert lake.vacuum("silver", keep=1, unnamed_before=now() + timedelta(days=1)) == [running]
    with pytest.raises(ValueError):
        lake.vacuum("silver", keep=0)


def test_vacuum_beside_a_load(spark, shop, monkeypatch):
    """A load that has read its layer and written some tables is not disturbed."""
    removed = []
    write = Lake.write

    def write_and_vacuum(self, *args, **more):
        out = write(self, *args, **more)
        removed.extend(self.vacuum("gold", keep=1))
        removed.extend(self.vacuum("silver", keep=1, superseded_before=DAY1))
        return out

    before = shop.read("gold", "fact_sales").count()
    monkeypatch.setattr(Lake, "write", write_and_vacuum)
    load_gold(spark, shop.root, DAY3)
    monkeypatch.undo()
    gold = shop.layer("gold")
    assert gold["fact_sales"].count() == before
    assert sorted(r[0] for r in gold["fact_sales"].select("sales_key").collect()) == list(range(1, before + 1))
    gone = shop.vacuum("gold", keep=1)
    assert any("fact_sales_identity" in p for p in gone) and any("/fact_sales/" in p for p in gone)
    assert shop.layer("gold")["fact_sales"].count() == before

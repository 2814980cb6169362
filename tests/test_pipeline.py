"""The daily run over the derived tables: reload, history and quarantine."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.marts import MARTS
from tallyhouse.plans.pipeline import extract, load_raw, run_day, silver_view
from tallyhouse.sources import read_layer

DAY = "1998-01-05"
NAMES = (
    "geo_location", "customers", "orders", "order_items", "product", "brand", "sub_category", "category", "warehouse",
    "logistics_partner", "shipping_method", "inventory", "inventory_log", "order_return", "shipment",
    "customer_activity_log", "cart", "product_review", "wishlist",
)


@pytest.fixture(scope="module")
def lake(spark, retail, tmp_path_factory):
    """Every table as if it had changed on the day of the run, with one broken order."""
    root = str(tmp_path_factory.mktemp("lake"))
    sources = {}
    for name in NAMES:
        df = retail[name]
        if name in ("inventory_log", "order_items", "product_review"):
            df = df.withColumn("id", F.monotonically_increasing_id())
        if name in ("customers", "orders", "order_return", "inventory_log", "customer_activity_log", "cart"):
            df = df.withColumn("created_at", F.lit(DAY).cast("timestamp")).withColumn(
                "updated_at", F.lit(None).cast("timestamp"))
        sources[name] = df
    broken = sources["orders"].limit(1).withColumn("id", F.lit(None).cast("bigint"))
    sources["orders"] = sources["orders"].unionByName(broken)
    run_day(spark, sources, root, DAY, marts=())
    run_day(spark, sources, root, DAY)
    return root, sources


def test_rerun_does_not_double_silver(spark, lake, retail):
    root, _ = lake
    assert silver_view(spark, "orders", root).count() == retail["orders"].count()
    assert read_layer(spark, root, "silver", "orders").count() == retail["orders"].count()


def test_broken_rows_are_quarantined(spark, lake):
    root, _ = lake
    rejected = read_layer(spark, root, "quarantine", "orders")
    assert [row.reject_reason for row in rejected.collect()] == ["null_id"]


def test_every_mart_is_written_once(spark, lake):
    root, _ = lake
    for name, spec in MARTS.items():
        rows = read_layer(spark, root, "gold", name)
        assert rows.count() > 0
        assert {"processed_at", "ds", spec.partition_by} <= set(rows.columns)
    retention = read_layer(spark, root, "gold", "customer_retention")
    assert retention.count() == retention.select("customer_id").distinct().count()


def test_silver_is_local_time_and_traced(spark, lake):
    root, _ = lake
    row = silver_view(spark, "orders", root).first()
    assert str(row.created_at) == f"{DAY} 07:00:00"
    assert row._source_table == "raw.orders"


def test_marts_agree_with_silver(spark, lake):
    root, _ = lake
    mart = read_layer(spark, root, "gold", "daily_sales_mart").selectExpr("sum(total_orders) n", "sum(total_revenue) r").first()
    orders = silver_view(spark, "orders", root).selectExpr("count(*) n", "sum(total_price) r").first()
    assert (mart.n, mart.r) == (orders.n, orders.r)


def test_a_later_day_replaces_the_version(spark, lake, tmp_path):
    root, sources = lake
    root = str(tmp_path / "copy")
    small = {"orders": sources["orders"].filter("id < 10")}
    run_day(spark, small, root, DAY, marts=())
    moved = small["orders"].filter("id = 3").withColumns(
        {"status": F.lit("Refunded"), "updated_at": F.lit("1998-01-06 09:00:00").cast("timestamp")})
    run_day(spark, {"orders": moved}, root, "1998-01-06", marts=())
    current = {row.id: row.status for row in silver_view(spark, "orders", root).collect()}
    assert len(current) == small["orders"].filter("id is not null").count()
    assert current[3] == "REFUNDED"


def test_nothing_new_writes_nothing(spark, lake, tmp_path):
    _, sources = lake
    assert extract("orders", sources["orders"], "2030-01-01").isEmpty()
    assert not load_raw("orders", sources["orders"], str(tmp_path), "2030-01-01")
    assert not Path(tmp_path / "raw").exists()


def test_a_table_never_loaded_is_empty(spark, tmp_path):
    assert silver_view(spark, "orders", str(tmp_path)).isEmpty()


@pytest.fixture
def carts(spark):
    def day(ds, *rows):
        return spark.createDataFrame(list(rows), "id long, status string, total_amount int").selectExpr(
            "id", "1L customer_id", "'Web' channel", "status", "cast(total_amount as decimal(12,2)) total_amount", "1 item_count",
            f"timestamp'{ds} 10:00:00' created_at", "cast(null as timestamp) updated_at")

    return day


def test_a_reload_with_only_rejected_rows_clears_the_day(spark, carts, tmp_path):
    root = str(tmp_path)
    run_day(spark, {"cart": carts(DAY, (1, "active", 5))}, root, DAY, marts=())
    run_day(spark, {"cart": carts(DAY, (None, "active", 5))}, root, DAY, marts=())
    assert silver_view(spark, "cart", root).isEmpty()
    assert read_layer(spark, root, "quarantine", "cart").count() == 1


def test_an_emptied_source_clears_the_day_and_no_other(spark, carts, tmp_path):
    root, later = str(tmp_path), "1998-01-06"
    run_day(spark, {"cart": carts(DAY, (1, "active", 5))}, root, DAY, marts=())
    run_day(spark, {"cart": carts(later, (2, "active", 6))}, root, later, marts=())
    run_day(spark, {"cart": carts(later, (2, "active", 6)).limit(0)}, root, later, marts=())
    assert [row.id for row in silver_view(spark, "cart", root).collect()] == [1]
    assert [str(row.ingestion_date) for row in read_layer(spark, root, "raw", "cart").collect()] == [DAY]


def test_a_mart_of_an_earlier_day_sees_that_day(spark, carts, tmp_path):
    root, later = str(tmp_path), "1998-01-06"
    run_day(spark, {"cart": carts(DAY, (1, "active", 5))}, root, DAY, marts=())
    run_day(spark, {"cart": carts(later, (1, "abandoned", 9), (2, "active", 1))}, root, later, marts=())
    assert {(r.id, r.status) for r in silver_view(spark, "cart", root, DAY).collect()} == {(1, "active")}
    assert {r.id for r in silver_view(spark, "cart", root, later).collect()} == {1, 2}
    assert silver_view(spark, "cart", root, "1998-01-04").isEmpty()

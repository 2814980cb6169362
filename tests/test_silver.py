from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tallyhouse.operators.silver import backfill, clean, with_lineage


def test_orders_are_shifted_trimmed_and_filtered(spark):
    data = [
        (1, "2024-01-15 20:00:00", " delivered ", "10.005"),
        (2, "2024-01-15 20:00:00", "PENDING", "-0.01"),
        (3, "2024-01-15 20:00:00", None, None),
        (4, None, "Completed", "0"),
    ]
    df = spark.createDataFrame(data, "id long, at string, status string, price string").selectExpr(
        "id", "cast(at as timestamp) order_date", "cast(at as timestamp) created_at", "status",
        "cast(price as decimal(11,3)) total_price",
    )
    result = {row.id: row for row in clean("orders", df).collect()}
    assert set(result) == {1, 4}
    assert result[1].order_date == datetime(2024, 1, 16, 3, 0)
    assert result[1].status == "DELIVERED"
    assert result[1].total_price == Decimal("10.01")
    assert result[4].order_date is None


def items(spark, *data):
    return spark.createDataFrame(
        data, "id long, order_id long, product_id long, unit_price string, amount string"
    ).selectExpr("id", "order_id", "product_id", "cast(unit_price as decimal(12,2)) unit_price",
                 "cast(amount as decimal(12,2)) amount")


def test_item_dedupe_is_deterministic(spark):
    data = [(3, 1, 1, "1", "3"), (1, 1, 1, "1", "1"), (2, 1, 2, "1", "2"), (4, None, 1, "1", "4"), (5, 1, None, "1", "5")]
    for order in (data, data[::-1]):
        kept = clean("order_items", items(spark, *order).repartition(3)).collect()
        assert sorted(row.id for row in kept) == [1, 2]


def test_item_types_widen(spark):
    cleaned = clean("order_items", items(spark, (1, 1, 1, "1.25", "2.50")))
    assert dict(cleaned.dtypes)["amount"] == "decimal(18,2)"


def test_geo_is_untouched_and_unknown_tables_use_the_default(spark):
    df = spark.range(1).selectExpr("id", "timestamp'2024-01-15 00:00:00' created_at")
    assert clean("geo_location", df).first().created_at == datetime(2024, 1, 15)
    assert clean("brand", df).first().created_at == datetime(2024, 1, 15, 7)
    assert clean("brand", spark.range(1)).columns == ["id"]


def test_all_timestamps_of_a_table_move_together(spark):
    df = spark.range(1).selectExpr(
        "timestamp'2024-01-15 00:00:00' created_at", "timestamp'2024-01-15 05:00:00' actual_delivery",
        "timestamp'2024-01-15 00:00:00' ingested_at",
    )
    row = clean("shipment", df).first()
    assert (row.actual_delivery - row.created_at).total_seconds() == 5 * 3600
    assert row.ingested_at == datetime(2024, 1, 15)


def test_history_wishlist_and_cart_items(spark):
    df = spark.range(1).selectExpr("id", "' x ' status", "timestamp'2024-01-15 00:00:00' changed_at")
    assert clean("order_status_history", df).first().status == "X"
    for name in ("wishlist", "cart_items"):
        row = clean(name, spark.range(1).selectExpr("timestamp'2024-01-15 00:00:00' added_at")).first()
        assert row.added_at == datetime(2024, 1, 15, 7)


def test_lineage_and_backfill(spark):
    row = with_lineage(spark.range(1), "raw.orders", "run-1", "v2").first()
    assert (row._source_table, row._pipeline_run_id, row._data_version) == ("raw.orders", "run-1", "v2")
    assert row.processed_at is not None
    df = backfill(spark.range(1).selectExpr("current_timestamp() created_at"), "created_at", "2023-01-01")
    assert df.first().created_at == datetime(2023, 1, 1)

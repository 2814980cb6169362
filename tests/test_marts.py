"""Mart edge cases the generic tables do not hold."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from tallyhouse.plans.marts import MARTS, build
from tallyhouse.plans.marts.return_analysis import top_return_reasons

ROWS = {
    "orders": (
        "id long, customer_id long, shipping_id long, order_channel_id long, order_date timestamp, status string,"
        " total_price decimal(18,2), profit decimal(18,2)",
        [
            (1, 1, 1, 1, "2024-01-05 10:00:00", "Completed", "100", "30"),
            (2, 1, 2, 1, "2024-01-05 23:00:00", "CANCELLED", "50", "15"),
            (3, 2, 3, 2, "2024-01-06 00:00:00", " returned ", "10", "3"),
            (4, None, None, 2, "2024-01-06 01:00:00", "Pending", None, None),
        ],
    ),
    "order_items": (
        "order_id long, product_id long, quantity int, unit_price decimal(12,2), discount_amount decimal(12,2),"
        " amount decimal(12,2)",
        [(1, 1, 2, "20", "1", "39"), (1, 2, 1, "60", None, "60"), (1, 2, 1, "1", "0", "1"), (3, 1, 1, "10", "0", "10")],
    ),
    "customers": (
        "id long, name string, email string, phone string, geo_location_id long, tier string, loyalty_points int",
        [(1, "a", "a@x", "1", 7, "Gold", 5), (2, "b", "b@x", "2", 99, "Bronze", 0), (3, "c", None, None, None, None, None)],
    ),
    "geo_location": ("ward_code long, province_name string", [(7, "North"), (8, "South")]),
    "order_return": (
        "id long, order_id long, customer_id long, reason string, return_type string, status string,"
        " refund_amount decimal(12,2), created_at timestamp, resolved_at timestamp",
        [
            (1, 1, 1, "late", "refund", "pending", "20", "2024-01-07", None),
            (2, 1, 1, "late", "repair", "completed", None, "2024-01-07", "2024-01-10"),
            (3, 9, 3, "lost", "exchange", "rejected", "1", "2024-01-07", "2024-01-09"),
        ],
    ),
    "product": (
        "id long, name string, brand_id long, sub_category_id long, price decimal(12,2)",
        [(1, "p1", 1, 1, "20"), (2, "p2", None, 2, "60"), (3, "p3", 9, 9, None)],
    ),
    "brand": ("id long, name string", [(1, "B")]),
    "sub_category": ("id long, name string, category_id long", [(1, "s1", 1), (2, "s2", None)]),
    "category": ("id long, name string", [(1, "c1")]),
    "product_review": ("id long, product_id long, rating int", [(1, 1, 5), (2, 1, 4), (3, 2, None)]),
    "wishlist": ("id long, product_id long, is_active boolean", [(1, 1, True), (2, 1, False), (3, 3, None)]),
    "cart": (
        "id long, customer_id long, channel string, status string, total_amount decimal(12,2), item_count int",
        [(1, 1, "Web", "abandoned", "10", 1), (2, 1, "Web", "checked_out", None, 2), (3, 1, "App", "active", "5", None)],
    ),
    "customer_activity_log": (
        "id long, customer_id long, activity_type string, product_id long, channel string, created_at timestamp",
        [
            (1, 1, "view", 1, "Web", "2024-01-08 01:00:00"),
            (2, 1, "view", 1, "Web", "2024-01-09 01:00:00"),
            (3, 1, "purchase", 2, "App", "2024-01-07 01:00:00"),
            (4, 1, "search", None, "App", "2024-01-07 01:00:00"),
        ],
    ),
    "shipment": (
        "id long, logistics_partner_id long, shipping_method_id long, is_expedited boolean, shipping_status string,"
        " shipping_cost decimal(12,2), created_at timestamp, estimated_delivery timestamp, actual_delivery timestamp,"
        " delivery_attempts int",
        [
            (1, 1, 1, True, "Delivered", "10", "2024-01-05 00:00:00", "2024-01-07", "2024-01-06 12:00:00", 1),
            (2, 1, 1, None, "failed", "5", "2024-01-05 00:00:00", "2024-01-07", None, 2),
            (3, 9, None, False, "Created", None, "2024-01-06 00:00:00", None, None, None),
        ],
    ),
    "logistics_partner": ("id long, name string, rating decimal(3,2)", [(1, "Fast", "4.5")]),
    "shipping_method": ("id long, name string", [(1, "Std")]),
    "warehouse": ("id long, name string, geo_location_id long", [(1, "W1", 8), (2, "W2", None)]),
    "inventory": (
        "id long, product_id long, warehouse_id long, quantity int, safety_stock int, reorder_level int,"
        " unit_cost decimal(12,2)",
        [(1, 1, 1, 40, 10, 20, "2"), (2, 2, 1, 0, 0, 0, "3"), (3, 3, 2, 5, 10, 20, None), (4, 1, 9, 30, 10, 20, "1")],
    ),
    "inventory_log": (
        "id long, inventory_id long, change_type string, quantity_change int, created_at timestamp",
        [
            (1, 1, "sale", -20, "2024-01-01"),
            (2, 1, "restock", 50, "2024-01-05"),
            (3, 1, "damage", -3, "2024-01-11"),
            (4, 2, "sale", -4, "2024-01-02"),
            (5, 4, "return", 2, "2023-11-01"),
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark):
    made = {}
    for name, (ddl, data) in ROWS.items():
        fields = [part.strip().split(" ", 1) for part in ddl.replace(",2)", "~2)").split(",")]
        plain = {"long", "int", "boolean"}
        schema = ", ".join(f"{field} {kind if kind in plain else 'string'}" for field, kind in fields)
        made[name] = spark.createDataFrame(data, schema).selectExpr(
            *[f"cast({field} as {kind.replace('~', ',')}) {field}" for field, kind in fields]
        )
    return made


def by(df, *keys):
    return {tuple(row[key] for key in keys): row for row in df.collect()}


def test_order_money_counts_once_however_many_lines(tables):
    result = by(build("daily_sales_mart", tables, "2024-01-31"), "order_date", "province_name", "order_channel_id")
    row = result[(date(2024, 1, 5), "North", 1)]
    assert (row.total_orders, row.total_revenue, row.total_items_sold) == (2, D("150.00"), 4)
    assert (row.completed_orders, row.cancelled_orders, row.cancellation_rate) == (1, 1, 0.5)
    assert (row.total_returns_count, row.total_refund_amount) == (2, D("20.00"))
    assert row.avg_order_value == D("75.00")
    unknown = result[(date(2024, 1, 6), None, 2)]
    assert (unknown.total_orders, unknown.returned_orders, unknown.total_revenue) == (2, 1, D("10.00"))


def test_daily_totals_equal_the_orders(tables):
    mart = build("daily_sales_mart", tables, "2024-01-31")
    total = mart.selectExpr("sum(total_orders) n", "sum(total_revenue) r").first()
    assert (total.n, total.r) == (4, D("160.00"))


def test_every_customer_appears_once(tables):
    result = by(build("customer_analytics_mart", tables, "2024-01-31"), "customer_id")
    assert len(result) == 3
    first, idle = result[(1,)], result[(3,)]
    assert (first.total_items_purchased, first.total_carts_created, first.total_carts_checked_out) == (4, 3, 1)
    assert (first.days_since_last_order, first.first_order_date) == (26, date(2024, 1, 5))
    assert (idle.total_orders, idle.total_spent, idle.days_since_last_order, idle.total_returns) == (0, D("0.00"), None, 1)


def test_products_without_sales(tables):
    result = by(build("product_performance_mart", tables, "2024-01-31"), "product_id")
    sold, unsold = result[(1,)], result[(3,)]
    assert (sold.total_sold, sold.avg_rating, sold.total_return_events, sold.total_wishlist_adds) == (3, D("4.50"), 2, 1)
    assert sold.return_rate == pytest.approx(2 / 3)
    assert result[(2,)].total_return_events == 4
    assert result[(2,)].category_name is None and result[(2,)].sub_category_name == "s2"
    assert (unsold.return_rate, unsold.total_wishlist_adds, unsold.brand_name) == (0.0, 0, None)


def test_logistics_with_nothing_delivered(tables):
    result = by(build("logistics_mart", tables, "2024-01-31"), "logistics_partner_name", "province_name")
    row = result[("Fast", "North")]
    assert (row.total_shipments, row.expedited_ratio, row.avg_delivery_time_hours) == (2, D("50.00"), 36.0)
    assert (row.on_time_delivery_rate, row.failed_delivery_count, row.avg_delivery_attempts) == (100.0, 1, 1.5)
    none = [row for key, row in result.items() if key[0] is None]
    assert sum(row.total_shipments for row in none) == 1
    assert all(row.on_time_delivery_rate is None for row in none)


def test_snapshot_quantities_are_positive(tables):
    result = by(build("inventory_snapshot_mart", tables, "2024-01-31"), "product_id", "warehouse_name")
    row = result[(1, "W1")]
    assert (row.total_sales_qty_accumulated, row.total_restock_qty_accumulated) == (20, 50)
    assert (row.stock_value, row.province_name, row.snapshot_date) == (D("80.00"), "South", date(2024, 1, 31))
    assert result[(2, "W1")].is_out_of_stock and result[(3, "W2")].is_low_stock


def test_stock_health_guards(tables):
    result = by(build("inventory_analysis", tables, "2024-01-31"), "inventory_id")
    moving, empty, untouched, old = (result[(key,)] for key in (1, 2, 3, 4))
    assert (moving.stock_buffer_ratio, moving.turnover_rate, moving.days_of_stock_remaining) == (3.0, 0.5, 20.0)
    assert moving.damage_loss_rate == 5.0 and not moving.is_dead_stock
    assert empty.stock_buffer_ratio is None and empty.turnover_rate == 0.0 and not empty.is_dead_stock
    assert untouched.days_since_last_movement is None and untouched.is_dead_stock and untouched.stock_value is None
    assert old.is_dead_stock and old.is_critical_stock is False and old.days_of_stock_remaining is None


def test_cart_rates(tables):
    result = by(build("cart_analytics_mart", tables, "2024-01-31"), "channel")
    web, app = result[("Web",)], result[("App",)]
    assert (web.total_carts, web.cart_abandonment_rate, web.cart_conversion_rate) == (2, 50.0, 50.0)
    assert (web.avg_cart_value, web.avg_items_per_cart) == (D("10.00"), 1.5)
    assert (app.active_carts, app.avg_items_per_cart, app.cart_abandonment_rate) == (1, None, 0.0)


@pytest.mark.parametrize("as_of, segment", [
    ("2024-02-04", "Active"), ("2024-02-05", "At Risk"), ("2024-04-05", "Dormant"), ("2024-07-04", "Churned")])
def test_segments_follow_the_day(tables, as_of, segment):
    result = by(build("customer_retention", tables, as_of), "customer_id")
    assert result[(1,)].churn_segment == segment
    assert result[(3,)].churn_segment == "Never Purchased"


def test_retention_metrics(tables):
    row = by(build("customer_retention", tables, "2024-01-31"), "customer_id")[(1,)]
    assert (row.engagement_score, row.distinct_products_interacted, row.distinct_channels_used) == (8, 2, 2)
    assert (row.is_repeat_customer, row.avg_days_between_orders, row.distinct_order_dates) == (True, 0.0, 1)
    assert (row.cart_abandonment_rate, row.abandoned_cart_value, row.total_activities) == (33.33, D("10.00"), 4)
    assert row.last_activity_date == date(2024, 1, 9)


def test_a_return_counts_once_per_product(tables):
    result = by(build("return_analysis", tables, "2024-01-31"), "product_id")
    row = result[(2,)]
    assert (row.total_returns, row.distinct_orders_returned, row.refund_count, row.repair_count) == (2, 1, 1, 1)
    assert (row.total_quantity_in_returned_orders, row.total_product_orders, row.return_rate) == (4, 1, 1.0)
    assert (row.avg_refund_amount, row.avg_resolution_days) == (D("10.00"), 3.0)
    assert result[(1,)].return_rate == 0.5
    orphan = result[(None,)]
    assert (orphan.total_returns, orphan.return_rate, orphan.product_name) == (1, 0.0, None)


def test_top_reasons(tables):
    assert [tuple(row) for row in top_return_reasons(tables["order_return"]).collect()] == [("late", 2), ("lost", 1)]
    assert top_return_reasons(tables["order_return"], 1).count() == 1


def test_registry(tables):
    assert len(MARTS) == 9
    for name, spec in MARTS.items():
        assert spec.partition_by in build(name, tables, "2024-01-31").columns
    with pytest.raises(KeyError, match="known"):
        build("nope", tables, "2024-01-31")

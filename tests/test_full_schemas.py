"""Every job accepts the complete operational tables, and empty ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.catalog import TABLES
from tallyhouse.operators import (
    activity,
    carts,
    constraints,
    customers,
    inventory,
    orders,
    payments,
    promotions,
    quality,
    returns,
    reviews,
    shipping,
)
from tallyhouse.operators.silver import clean
from tallyhouse.plans import kpis
from tallyhouse.plans.marts import MARTS

JOBS = {
    "item_amounts": lambda t: orders.item_amounts(t["order_items"], t["product"]),
    "order_totals": lambda t: orders.order_totals(t["order_items"]),
    "costed_totals": lambda t: orders.order_totals(t["order_items"], t["inventory"].select("product_id", "unit_cost")),
    "payment_sync": lambda t: orders.payment_sync(t["orders"], t["payment"], t["order_items"]),
    "order_codes": lambda t: orders.order_codes(t["orders"]),
    "status_changes": lambda t: orders.status_changes(t["order_status_history"]),
    "invalid_transitions": lambda t: orders.invalid_transitions(t["order_status_history"]),
    "orders_without_items": lambda t: orders.orders_without_items(t["orders"], t["order_items"]),
    "cancel_overdue": lambda t: orders.cancel_overdue(t["orders"], F.lit("2024-01-01").cast("timestamp")),
    "stock_check": lambda t: inventory.stock_check(t["order_items"], t["product"], t["inventory"]),
    "allocate": lambda t: inventory.allocate(t["order_items"], t["inventory"]),
    "demand_cover": lambda t: inventory.demand_cover(t["order_items"], t["inventory"]),
    "change_log": lambda t: inventory.change_log(t["inventory"], t["inventory"]),
    "seed_gaps": lambda t: inventory.seed_gaps(t["product"], t["warehouse"], t["inventory"]),
    "movement_balance": lambda t: inventory.movement_balance(t["inventory_log"].withColumn("opening_quantity", F.lit(0))),
    "stocked_warehouses": lambda t: inventory.stocked_warehouses(t["warehouse"], t["inventory"]),
    "customer_tiers": lambda t: customers.customer_tiers(t["customers"], t["orders"]),
    "customer_codes": lambda t: customers.customer_codes(t["customers"], t["order_channel"]),
    "customers_without_cart": lambda t: customers.customers_without_cart(t["customers"], t["cart"]),
    "wishlist_candidates": lambda t: customers.wishlist_candidates(t["customers"], t["wishlist"], t["product"]),
    "validate_payments": lambda t: payments.validate_payments(
        t["payment"].withColumnsRenamed({"id": "payment_id"}).withColumns({"id": F.lit(1), "changed_at": F.col("updated_at")})),
    "payment_effects": lambda t: payments.payment_effects(t["order_status_history"], t["orders"]),
    "delivered_without_payment": lambda t: payments.delivered_without_payment(t["orders"], t["payment"]),
    "validate_returns": lambda t: returns.validate_returns(t["order_return"], t["orders"]),
    "returnable_orders": lambda t: returns.returnable_orders(t["orders"], t["order_return"]),
    "unique_reviews": lambda t: reviews.unique_reviews(t["product_review"]),
    "validate_reviews": lambda t: reviews.validate_reviews(t["product_review"]),
    "reviewable_pairs": lambda t: reviews.reviewable_pairs(t["orders"], t["order_items"], t["product_review"]),
    "sync_orders": lambda t: shipping.sync_orders(t["orders"], t["shipment"]),
    "shipment_counters": lambda t: shipping.shipment_counters(t["order_status_history"]),
    "expected_delivery": lambda t: shipping.expected_delivery(t["shipment"], t["shipping_method"]),
    "shipping_terms": lambda t: shipping.shipping_terms(t["orders"], t["shipment"]),
    "validate_discounts": lambda t: promotions.validate_discounts(t["discount"]),
    "discounts_in_force": lambda t: promotions.discounts_in_force(t["orders"], t["discount"]),
    "discount_split": lambda t: promotions.discount_split(t["order_items"], t["orders"], t["discount"]),
    "cart_item_amounts": lambda t: carts.cart_item_amounts(t["cart_items"], t["product"]),
    "cart_totals": lambda t: carts.cart_totals(t["cart"], t["cart_items"]),
    "validate_checkout": lambda t: carts.validate_checkout(t["cart"], t["cart_items"], t["product"], t["inventory"]),
    "addable_products": lambda t: carts.addable_products(t["cart"], t["cart_items"], t["product"]),
    "orders_from_carts": lambda t: carts.orders_from_carts(t["cart"], t["customers"]),
    "items_from_carts": lambda t: carts.items_from_carts(t["cart"], t["cart_items"]),
    "expired_carts": lambda t: carts.expired_carts(t["cart"], "2024-01-31"),
    "typed_payload": lambda t: activity.typed_payload(t["customer_activity_log"]),
    "daily_activity": lambda t: activity.daily_activity(t["customer_activity_log"]),
    "judge_order_totals": lambda t: quality.judge_order_totals(t["orders"], t["order_items"]),
    "sales_by_channel": lambda t: kpis.sales_by_channel(MARTS["daily_sales_mart"].build(t, "2024-01-31")),
    "inventory_turnover": lambda t: kpis.inventory_turnover(t["inventory"], t["inventory_log"]),
}


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.createDataFrame([], spec.schema) for name, spec in TABLES.items()}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_runs_on_full_empty_tables(tables, name):
    assert JOBS[name](tables).isEmpty()


@pytest.mark.parametrize("name", sorted(MARTS))
def test_mart_runs_on_full_empty_tables(tables, name):
    assert MARTS[name].build(tables, "2024-01-31").isEmpty()


@pytest.mark.parametrize("job", [
    lambda t: kpis.order_kpis(t["orders"]), lambda t: kpis.conversion_rate(t["orders"]),
    lambda t: kpis.return_rate(t["orders"], t["order_return"]), lambda t: kpis.shipping_sla(t["shipment"]),
    lambda t: kpis.customer_retention_rate(t["customers"], t["orders"]), lambda t: kpis.cart_kpis(t["cart"])])
def test_kpi_of_nothing_is_one_row_without_a_ratio(tables, job):
    row = job(tables).collect()
    assert len(row) == 1 and row[0][-1] is None


@pytest.mark.parametrize("name", sorted(TABLES))
def test_cleaning_and_constraints_of_every_table(tables, name):
    cleaned = clean(name, tables[name])
    assert set(cleaned.columns) == set(tables[name].columns) and cleaned.isEmpty()
    assert constraints.check_table(tables, name).filter("checked > 0 or failed > 0").isEmpty()

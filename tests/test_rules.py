"""Business rules on hand-made rows."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import carts, customers, inventory, orders, payments, promotions, returns, reviews, shipping
from tallyhouse.operators.activity import typed_payload


@pytest.fixture
def make(spark):
    def frame(ddl, *data):
        fields = [part.strip().rsplit(" ", 1) for part in ddl.split(";")]
        schema = ", ".join(f"{name} {'string' if kind not in ('long', 'int', 'boolean') else kind}" for name, kind in fields)
        df = spark.createDataFrame(data, schema)
        return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])

    return frame


ITEMS = "order_id long; product_id long; id long; quantity int; unit_price decimal(12,2); discount_amount decimal(12,2); amount decimal(12,2)"
PRODUCT = "id long; price decimal(12,2); is_active boolean"
STOCK = "id long; product_id long; warehouse_id long; quantity int"


@pytest.fixture
def product(make):
    return make(PRODUCT, (1, "10", True), (2, "20", False), (3, "30", True), (4, None, None))


@pytest.fixture
def stock(make):
    return make(STOCK, (11, 1, 1, 5), (12, 1, 2, 7), (13, 1, 3, 7), (14, 2, 1, 9), (15, 3, 1, 0))


@pytest.fixture
def items(make):
    return make(
        ITEMS,
        (1, 1, 1, 2, None, None, None),
        (1, 2, 2, 1, "5", "1", "4"),
        (2, 1, 3, 8, "10", "0", "80"),
        (2, 3, 4, 1, "3", "5", "-2"),
        (3, 9, 5, 1, "1", "0", "1"),
    )


def test_item_amount_takes_the_list_price(items, product):
    result = {row.id: (row.unit_price, row.amount) for row in orders.item_amounts(items, product).collect()}
    assert result[1] == (D("10.00"), D("20.00"))
    assert result[2] == (D("5.00"), D("4.00"))
    assert len(result) == 5


def test_order_totals_and_profit(items, make):
    result = {row.order_id: row for row in orders.order_totals(items).collect()}
    assert (result[1].total_price, result[1].profit, result[1].item_count) == (D("4.00"), D("1.20"), 2)
    costs = make("product_id long; unit_cost decimal(12,2)", (1, "2"), (3, "1"))
    costed = {row.order_id: row.profit for row in orders.order_totals(items, costs).collect()}
    assert costed[2] == D("61.00")


def test_header_is_at_least_one(make):
    rows = orders.header_rollup(make(ITEMS, (1, 1, 1, 1, "1", "5", "-4"), (2, 1, 2, 1, "5", "0", "5"))).collect()
    assert {row.order_id: row.total_price for row in rows} == {1: D("1.00"), 2: D("5.00")}


def test_stock_check_reasons(items, product, stock):
    result = {row.id: row.reject_reason for row in inventory.stock_check(items, product, stock).collect()}
    assert result == {1: None, 2: "inactive_product", 3: None, 4: "insufficient_stock", 5: "insufficient_stock"}


def test_allocation_picks_the_fullest_warehouse(items, stock):
    result = {row.id: row for row in inventory.allocate(items, stock).collect()}
    assert (result[1].inventory_id, result[1].allocated_warehouse_id) == (12, 2)
    assert result[3].reject_reason == "no_single_warehouse" and result[3].inventory_id is None
    assert result[4].reject_reason == "insufficient_stock"


def test_demand_cover_runs_in_order(make, stock):
    lines = make("id long; product_id long; quantity int; created_at timestamp",
                 (1, 1, 15, "2024-01-01"), (2, 1, 4, "2024-01-02"), (3, 1, 1, "2024-01-03"))
    result = {row.id: (row.running_demand, row.covered) for row in inventory.demand_cover(lines, stock).collect()}
    assert result == {1: (15, True), 2: (19, True), 3: (20, False)}


def test_change_log_has_one_row_per_change(make):
    before = make("id long; quantity int", (1, 5), (2, 5), (3, 5))
    after = make("id long; quantity int", (1, 5), (2, 9), (4, 2))
    result = {row.inventory_id: (row.quantity_before, row.quantity_after, row.change_type)
              for row in inventory.change_log(before, after).collect()}
    assert result == {2: (5, 9, "restock"), 3: (5, 0, "sale"), 4: (0, 2, "restock")}


def test_seed_gaps_count_missing_warehouses(product, stock, make):
    warehouse = make("id long; name string", (1, "a"), (2, "b"))
    found = {row.product_id: (row.missing_warehouses, row.unit_cost) for row in inventory.seed_gaps(product, warehouse, stock).collect()}
    assert {k: v[0] for k, v in found.items()} == {1: 0, 2: 1, 3: 1, 4: 2}
    assert {k: found[k][1] for k in (2, 3, 4)} == {2: D("14.00"), 3: D("21.00"), 4: D("0.00")}


def test_movement_balance_drops_no_ops(make):
    log = make("inventory_id long; id long; quantity_change int; created_at timestamp; opening_quantity int",
               (1, 1, -3, "2024-01-01", 2), (1, 2, -1, "2024-01-01", 2), (1, 3, 4, "2024-01-02", 2))
    result = [(row.id, row.quantity_before, row.quantity_after) for row in
              inventory.movement_balance(log).orderBy("id").collect()]
    assert result == [(1, 2, 0), (3, 0, 4)]


HISTORY = "order_id long; id long; status string; changed_at timestamp"


def test_status_changes_and_invalid_transitions(make):
    history = make(
        HISTORY,
        (1, 1, "Pending", "2024-01-01"), (1, 2, " confirmed", "2024-01-02"), (1, 3, "CONFIRMED", "2024-01-03"),
        (1, 4, "Shipped", "2024-01-04"), (2, 5, "Delivered", "2024-01-01"), (2, 6, "Cancelled", "2024-01-02"),
        (3, 7, "DeliveryFailed", "2024-01-01"), (3, 8, "Shipped", "2024-01-02"),
    )
    assert sorted(row.id for row in orders.status_changes(history).collect()) == [1, 2, 4, 5, 6, 7, 8]
    invalid = {row.id: row.cancelled_after_delivery for row in orders.invalid_transitions(history).collect()}
    assert invalid == {4: False, 6: True}


def test_order_codes_number_in_id_order(make):
    df = make("id long; created_at timestamp", (20, "2024-01-02"), (7, "2024-01-01"))
    assert {row.id: row.order_code for row in orders.order_codes(df).collect()} == {
        7: "ORD_20240101_00001", 20: "ORD_20240102_00002"}


def test_long_numbers_keep_their_digits(spark):
    row = spark.range(1).select(orders.padded(F.lit(123456), 5).alias("a"), orders.padded(F.lit(7), 3).alias("b")).first()
    assert (row.a, row.b) == ("123456", "007")


@pytest.mark.parametrize("spent, tier, points", [
    ("49999999.99", "Gold", 9998), ("50000000", "Platinum", 15000), ("19999999", "Silver", 2999),
    ("5010000", "Silver", 752), ("4999999", "Bronze", 499), ("0", "Bronze", 0)])
def test_tiers_and_points(spark, spent, tier, points):
    value = F.lit(spent).cast("decimal(15,2)")
    row = spark.range(1).select(customers.tier_of(value).alias("t"), customers.loyalty_points(value).alias("p")).first()
    assert (row.t, row.p) == (tier, points)


def test_customers_without_orders_stay_bronze(make):
    people = make("id long", (1,), (2,))
    placed = make("id long; customer_id long; status string; total_price decimal(18,2)",
                  (1, 1, "Completed", "6000000"), (2, 1, "PENDING", "9"))
    result = {row.customer_id: (row.tier, row.completed_orders) for row in customers.customer_tiers(people, placed).collect()}
    assert result == {1: ("Silver", 1), 2: ("Bronze", 0)}


def test_customer_codes_count_per_channel(make):
    people = make("id long; order_channel_id long", (1, 1), (5, 2), (9, 1))
    channels = make("id long; name string", (1, "Shopee"), (2, "Tiki"))
    result = {row.id: (row.customer_code, row.email) for row in customers.customer_codes(people, channels).collect()}
    assert result[9] == ("KH_Shopee_002", "kh.shopee.002@gmail.com")
    assert result[5][0] == "KH_Tiki_001"


def test_first_open_product(make, product):
    people = make("id long; is_active boolean", (1, True), (2, True), (3, True), (4, False))
    wished = make("customer_id long; product_id long", (1, 1), (1, 1), (2, 1), (2, 3), (3, 3), (3, 2))
    result = {row.customer_id: (row.open_products, row.first_product_id)
              for row in customers.wishlist_candidates(people, wished, product).collect()}
    assert result == {1: (1, 3), 2: (0, None), 3: (1, 1)}


def test_payment_rules(make):
    history = make("payment_id long; id long; payment_status string; amount decimal(12,2); changed_at timestamp",
                   (1, 1, "Pending", "10", "2024-01-01"), (1, 2, "Refunded", "10", "2024-01-02"),
                   (2, 3, "Completed", "10", "2024-01-01"), (2, 4, "Refunded", "0", "2024-01-02"),
                   (3, 5, "Refunded", "1", "2024-01-01"), (4, 6, "Pending", None, "2024-01-01"))
    result = {row.id: row.reject_reason for row in payments.validate_payments(history).collect()}
    assert result == {1: None, 2: "refund_not_from_completed", 3: None, 4: "amount_not_positive", 5: None, 6: None}


def test_return_rules_accept_both_layers(make):
    placed = make("id long; status string; total_price decimal(18,2)",
                  (1, "Delivered", "10"), (2, "COMPLETED", "10"), (3, "Pending", "10"))
    asked = make("id long; order_id long; refund_amount decimal(12,2)",
                 (1, 1, "10"), (2, 2, "10.01"), (3, 3, "99"), (4, 9, "1"), (5, 1, None))
    result = {row.id: row.reject_reason for row in returns.validate_returns(asked, placed).collect()}
    assert result == {1: None, 2: "refund_above_total", 3: "order_not_delivered,refund_above_total", 4: "order_missing", 5: None}


def test_shipment_effects(make):
    placed = make("id long; shipping_id long; status string",
                  (1, 1, "Shipped"), (2, 2, "Cancelled"), (3, 3, "Delivered"), (4, 4, "Shipped"), (5, 5, "Pending"))
    sent = make("id long; shipping_status string; delivery_attempts int",
                (1, "Delivered", 0), (2, "Delivered", 0), (3, "InTransit", 1), (4, "Failed", None), (5, "ReturnToSender", 2))
    result = {row.order_id: (row.synced_status, row.delivery_attempts) for row in shipping.sync_orders(placed, sent).collect()}
    assert result == {1: ("DELIVERED", 0), 2: ("CANCELLED", 0), 3: ("DELIVERED", 1), 4: ("SHIPPED", 1), 5: ("RETURNED", 2)}


def test_shipment_counters(make):
    history = make(HISTORY, (1, 1, "Shipped", "2024-01-01"), (1, 2, "DeliveryFailed", "2024-01-02"),
                   (2, 3, "DeliveryFailed", "2024-01-01"), (2, 4, "Shipped", "2024-01-02"),
                   (3, 5, "Completed", "2024-01-03"), (4, 6, "Pending", "2024-01-03"))
    result = {row.order_id: (row.shipping_status, row.delivery_attempts) for row in shipping.shipment_counters(history).collect()}
    assert result == {1: ("Failed", 1), 2: ("InTransit", 1), 3: ("Delivered", 0), 4: ("Created", 0)}


def test_shipping_terms(make):
    placed = make("id long; shipping_id long; total_price decimal(18,2)", (1, 1, "600000"), (2, 2, "600000"), (3, 3, "1"))
    sent = make("id long; is_expedited boolean; shipping_cost decimal(12,2); delivery_attempts int",
                (1, False, "9000", 3), (2, True, "9000", 0), (3, None, "9000", 2))
    result = {row.order_id: (row.fee, row.return_to_sender) for row in shipping.shipping_terms(placed, sent).collect()}
    assert result == {1: (D("0.00"), True), 2: (D("30000.00"), False), 3: (D("9000.00"), False)}


DISCOUNT = "id long; discount_type string; value decimal(12,2); start_date timestamp; end_date timestamp; is_active boolean; created_at timestamp"


@pytest.fixture
def discount(make):
    return make(
        DISCOUNT,
        (1, "%", "20", "2024-01-01", "2024-01-10 12:00:00", True, "2024-01-01"),
        (2, "fixed", "90", "2024-01-05", "2024-01-06", True, "2024-01-01"),
        (3, "%", "71", "2024-01-09", "2024-01-08", True, "2024-02-01"),
        (4, "fixed", "0", "2024-01-01", "2024-12-31", False, None),
    )


def test_discount_rules(discount):
    result = {row.id: row.reject_reason for row in promotions.validate_discounts(discount).collect()}
    assert result == {1: None, 2: None, 3: "start_after_end,ends_before_creation,percent_too_high", 4: "value_not_positive"}


def test_range_join_compares_moments(make, discount, rows):
    placed = make("id long; order_date timestamp", (1, "2024-01-05"), (2, "2024-01-10 12:00:00"),
                  (3, "2024-01-10 12:00:01"), (4, "2023-12-31"))
    result = promotions.discounts_in_force(placed, discount)
    assert rows(result, "order_id", "discounts", "best_discount_id") == [(1, 2, 2), (2, 1, 1), (3, 0, None), (4, 0, None)]
    assert rows(promotions.in_force(discount, "2024-01-06"), "id") == [(1,), (2,)]


def test_a_discount_without_an_end_spans_only_days_with_orders(make, rows):
    open_ended = make("id long; value int; start_date timestamp; end_date timestamp; is_active boolean",
                      (1, 5, "1900-01-01", "9999-12-31", True), (2, 9, "2030-01-01", "9999-12-31", True))
    placed = make("id long; order_date timestamp", (1, "2024-01-05"), (2, "2024-01-10"))
    result = promotions.discounts_in_force(placed, open_ended)
    assert rows(result, "order_id", "discounts", "best_discount_id") == [(1, 1, 1), (2, 1, 1)]
    assert promotions.discounts_in_force(placed.limit(0), open_ended).count() == 0


def test_discount_split(make, discount):
    placed = make("id long; discount_id long", (1, 1), (2, 2), (3, None))
    lines = make(ITEMS, (1, 1, 1, 3, "9.99", None, None), (2, 1, 2, 1, "10", None, None), (2, 2, 3, 1, "100", None, None),
                 (2, 3, 4, 1, "100", None, None), (3, 1, 5, 2, "4", None, None))
    result = {row.id: (row.discount_amount, row.amount) for row in promotions.discount_split(lines, placed, discount).collect()}
    assert result == {1: (D("5.99"), D("23.98")), 2: (D("30.00"), D("0.00")), 3: (D("30.00"), D("70.00")),
                      4: (D("30.00"), D("70.00")), 5: (D("0.00"), D("8.00"))}


def test_reviews_keep_the_first_active(make, rows):
    df = make("id long; product_id long; customer_id long; source_system string; is_active boolean; created_at timestamp; rating int",
              (2, 1, 1, "Web", True, "2024-01-02", 5), (1, 1, 1, "Web", False, "2024-01-01", 1),
              (3, 1, 1, "Web", True, "2024-01-03", 4), (4, 1, 1, "App", True, "2024-01-03", 3))
    assert rows(reviews.validate_reviews(df).filter("reject_reason is not null"), "id") == [(3,)]
    kept = reviews.unique_reviews(df)
    assert rows(kept, "id", "rejected_reviews") == [(2, 1), (4, 0)]


CART = "id long; customer_id long; status string; is_active boolean; total_amount decimal(12,2); item_count int; updated_at timestamp"
CART_ITEMS = "cart_id long; product_id long; quantity int; unit_price decimal(12,2); discount_amount decimal(12,2); amount decimal(12,2); is_active boolean"


@pytest.fixture
def cart(make):
    return make(CART, (1, 1, "active", True, "0", 0, "2024-01-01"), (2, 1, "active", True, "5", 1, "2024-01-20"),
                (3, 2, "checked_out", True, "5", 1, "2024-01-01"), (4, 2, "active", True, "0", 0, "2024-01-24"))


@pytest.fixture
def cart_items(make):
    return make(CART_ITEMS, (1, 1, 2, "0", None, None, True), (1, 2, 1, "5", "1", "4", True), (2, 3, 1, None, "0", "30", True),
                (3, 1, 1, "10", "0", "10", True), (1, 3, 1, "3", "0", "3", False), (9, 1, 1, "3", "0", "3", True))


def test_cart_item_amounts(cart_items, product, rows):
    result = carts.cart_item_amounts(cart_items, product)
    assert rows(result.filter("cart_id = 1"), "product_id", "unit_price", "amount", "reject_reason") == [
        (1, D("10.00"), D("20.00"), None), (2, D("5.00"), D("4.00"), "inactive_product"), (3, D("3.00"), D("3.00"), None)]


def test_cart_totals_count_active_items(cart, cart_items):
    result = {row.id: (row.total_amount, row.item_count) for row in carts.cart_totals(cart, cart_items).collect()}
    assert result == {1: (D("4.00"), 2), 2: (D("30.00"), 1), 3: (D("10.00"), 1), 4: (D("0.00"), 0)}


def test_checkout(cart, cart_items, product, stock):
    filled = carts.cart_totals(cart, cart_items)
    result = {row.id: row.reject_reason for row in carts.validate_checkout(filled, cart_items, product, stock).collect()}
    assert result == {1: None, 2: "insufficient_stock", 3: "not_active", 4: "empty_cart"}


def test_reactivation(spark):
    cases = [("checked_out", "active", False), ("expired", "active", False), ("abandoned", "active", True),
             ("active", "expired", True)]
    df = spark.createDataFrame(cases, "old string, new string, allowed boolean")
    assert df.filter(carts.reactivation_allowed("old", "new") != F.col("allowed")).count() == 0


def test_addable_conversion_and_expiry(cart, cart_items, product, make, rows):
    assert rows(carts.addable_products(cart, cart_items, product)) == [(1, 0, None), (2, 1, 1), (4, 2, 1)]
    people = make("id long; geo_location_id long; order_channel_id long", (1, 7, 2))
    assert rows(carts.orders_from_carts(cart, people), "cart_id", "location_id", "status") == [(2, 7, "PENDING")]
    assert rows(carts.items_from_carts(cart, cart_items), "cart_id", "product_id") == [(2, 3)]
    assert rows(carts.expired_carts(cart, "2024-01-27 12:00:00"), "id") == [(1,), (2,)]


def test_payload_by_activity(make):
    df = make("id long; metadata string", (1, '{"keyword": "tai nghe", "results_count": 3}'),
              (2, '{"duration_seconds": 9, "source": "ad"}'), (3, '{"quantity": 2}'), (4, "{}"), (5, None), (6, "broken"))
    result = {row.id: (row.keyword, row.results_count, row.duration_seconds, row.source, row.quantity)
              for row in typed_payload(df).collect()}
    assert result[1] == ("tai nghe", 3, None, None, None)
    assert result[2] == (None, None, 9, "ad", None)
    assert result[3][4] == 2
    assert result[4] == result[5] == result[6] == (None,) * 5


def test_overdue_orders(make, rows):
    df = make("id long; status string; created_at timestamp", (1, "Pending", "2024-01-01 10:00:00"),
              (2, "PENDING", "2024-01-01 10:30:00"), (3, "Confirmed", "2024-01-01 09:00:00"))
    at = F.lit("2024-01-01 10:45:00").cast("timestamp")
    assert rows(orders.cancel_overdue(df, at), "id") == [(1,)]

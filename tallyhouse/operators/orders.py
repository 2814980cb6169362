"""Order lines, totals, codes and status changes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import canonical, money, or_zero, status_is, total
from tallyhouse.operators.sequence import dense_sequence, previous_value
from tallyhouse.operators.skew import absent_from, salted_join

# Fixed value: flat margin on an order.
MARGIN = Decimal("0.30")

# The order life cycle as (from, to).
ORDER_TRANSITIONS = (
    ("Pending", "Confirmed"),
    ("Pending", "Cancelled"),
    ("Confirmed", "Processing"),
    ("Processing", "Packed"),
    ("Packed", "Shipped"),
    ("Shipped", "Delivering"),
    ("Delivering", "Delivered"),
    ("Delivering", "DeliveryFailed"),
    ("DeliveryFailed", "Shipped"),
    ("DeliveryFailed", "Returned"),
    ("Delivered", "Completed"),
    ("Delivered", "ReturnRequested"),
    ("ReturnRequested", "Returned"),
    ("ReturnRequested", "Completed"),
    ("Returned", "Refunded"),
    ("Cancelled", "Refunded"),
)


def item_amounts(items: DataFrame, product: DataFrame) -> DataFrame:
    """Fill a missing unit price from the product and compute the line amount."""
    prices = product.select(F.col("id").alias("product_id"), F.col("price").alias("_list_price"))
    priced = items.join(prices, "product_id", "left").withColumn(
        "unit_price", F.coalesce("unit_price", "_list_price")
    )
    amount = F.col("unit_price") * F.col("quantity") - or_zero("discount_amount")
    return priced.withColumn("amount", money(amount)).drop("_list_price")


def order_totals(items: DataFrame, unit_costs: DataFrame | None = None) -> DataFrame:
    """Total, profit and line count per order.

    Profit is the flat margin, or total minus cost when ``unit_costs``
    (product_id, unit_cost) is given.
    """
    lines = items
    cost = F.lit(0)
    if unit_costs is not None:
        lines = salted_join(items, unit_costs, "product_id")
        cost = or_zero(F.col("unit_cost") * F.col("quantity"))
    totals = lines.groupBy("order_id").agg(
        money(or_zero(F.sum("amount"))).alias("total_price"),
        F.sum(cost).alias("_cost"),
        F.count(F.lit(1)).alias("item_count"),
    )
    flat = F.col("total_price") * F.lit(MARGIN)
    profit = flat if unit_costs is None else F.col("total_price") - F.col("_cost")
    return totals.withColumn("profit", money(profit)).drop("_cost")


def header_rollup(items: DataFrame) -> DataFrame:
    """Order header total; an order that adds up to nothing is booked as 1."""
    totals = order_totals(items).select("order_id", "total_price", "item_count")
    positive = F.when(F.col("total_price") <= 0, F.lit(1)).otherwise(F.col("total_price"))
    return totals.withColumn("total_price", money(positive))


def payment_sync(orders: DataFrame, payment: DataFrame, items: DataFrame) -> DataFrame:
    """Payments whose amount differs from the rolled-up total of their order."""
    due = (
        orders.select(F.col("id").alias("order_id"), "payment_id")
        .join(header_rollup(items), "order_id")
        .select("payment_id", F.col("total_price").alias("new_amount"))
    )
    paid = payment.select(F.col("id").alias("payment_id"), F.col("amount").alias("old_amount"))
    return paid.join(due, "payment_id").filter(~F.col("old_amount").eqNullSafe(F.col("new_amount")))


def padded(number: Column, width: int) -> Column:
    """Zero-padded text that keeps all digits of a longer number."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def order_codes(orders: DataFrame) -> DataFrame:
    """``ORD_YYYYMMDD_00001``: creation day and a running number in id order."""
    numbered = dense_sequence(orders, "id", "_number")
    code = F.concat(
        F.lit("ORD_"),
        F.date_format("created_at", "yyyyMMdd"),
        F.lit("_"),
        padded(F.col("_number"), 5),
    )
    return numbered.withColumn("order_code", code).drop("_number")


def status_changes(
    history: DataFrame, order: tuple[str, ...] = ("changed_at", "id"), previous: str = "previous_status"
) -> DataFrame:
    """History rows where the status differs from the one before (first row included)."""
    steps = previous_value(history.withColumn("status", canonical("status")), ["order_id"], order, "status", previous)
    return steps.filter(~F.col("status").eqNullSafe(F.col(previous)))


def invalid_transitions(history: DataFrame, order: tuple[str, ...] = ("changed_at", "id")) -> DataFrame:
    """Status changes the order life cycle does not allow."""
    allowed = [f"{was}>{becomes}".upper() for was, becomes in ORDER_TRANSITIONS]
    step = F.concat_ws(">", "previous_status", "status")
    return (
        status_changes(history, order)
        .filter(F.col("previous_status").isNotNull() & ~step.isin(allowed))
        .withColumn(
            "cancelled_after_delivery",
            status_is("previous_status", "Delivered") & status_is("status", "Cancelled"),
        )
    )


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Pending orders that have no line yet."""
    return absent_from(orders.filter(status_is("status", "Pending")), items, {"id": "order_id"})


def lifetime_spend(orders: DataFrame) -> DataFrame:
    """Money of completed orders per customer."""
    return (
        orders.filter(status_is("status", "Completed"))
        .groupBy("customer_id")
        .agg(total(F.sum("total_price")).alias("total_spent"), F.count(F.lit(1)).alias("completed_orders"))
    )


def cancel_overdue(orders: DataFrame, at: Column, minutes: int = 30) -> DataFrame:
    """Pending orders still unconfirmed ``minutes`` after creation."""
    # Fixed value: 30 minutes to confirm.
    deadline = F.col("created_at") + F.make_dt_interval(mins=F.lit(minutes))
    return orders.filter(status_is("status", "Pending") & (deadline < at))

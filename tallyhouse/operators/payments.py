"""Payment rules and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import status_in, status_is
from tallyhouse.operators.sequence import previous_value
from tallyhouse.operators.skew import absent_from
from tallyhouse.operators.validation import Rule, validate


def validate_payments(history: DataFrame, order: tuple[str, ...] = ("changed_at", "id")) -> DataFrame:
    """Judge each payment change: refunds follow Completed, amounts are positive."""
    steps = previous_value(history, ["payment_id"], order, "payment_status", "previous_status")
    refund = status_is("payment_status", "Refunded")
    return validate(
        steps,
        [
            Rule("refund_not_from_completed", ~refund | status_is("previous_status", "Completed")),
            Rule("amount_not_positive", F.col("amount") > 0),
        ],
    )


def payment_effects(history: DataFrame, orders: DataFrame) -> DataFrame:
    """Payment status that follows from the order: completed orders complete
    their payment, cancelled ones cancel it."""
    ended = history.filter(status_in("status", "Completed", "Cancelled"))
    per_order = ended.groupBy("order_id").agg(
        F.when(F.count_if(status_is("status", "Completed")) > 0, "Completed")
        .otherwise("Cancelled")
        .alias("payment_status")
    )
    paid = orders.select(F.col("id").alias("order_id"), "payment_id")
    return per_order.join(paid, "order_id").select("payment_id", "payment_status")


def delivered_without_payment(orders: DataFrame, payment: DataFrame) -> DataFrame:
    """Delivered or completed orders that have no payment record."""
    delivered = orders.filter(status_in("status", "Delivered", "Completed"))
    return absent_from(delivered, payment, {"payment_id": "id"})

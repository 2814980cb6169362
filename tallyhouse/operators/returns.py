"""Return requests: validity and eligible orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import status_in
from tallyhouse.operators.skew import absent_from
from tallyhouse.operators.validation import Rule, validate


def validate_returns(order_return: DataFrame, orders: DataFrame) -> DataFrame:
    """A return needs a delivered or completed order and may not exceed its total."""
    placed = orders.select(
        F.col("id").alias("order_id"),
        F.col("status").alias("order_status"),
        F.col("total_price").alias("order_total"),
    )
    return validate(
        order_return.join(placed, "order_id", "left"),
        [
            Rule("order_missing", F.col("order_status").isNotNull()),
            Rule("order_not_delivered", status_in("order_status", "Delivered", "Completed")),
            Rule("refund_above_total", F.col("refund_amount") <= F.col("order_total")),
        ],
    )


def returnable_orders(orders: DataFrame, order_return: DataFrame) -> DataFrame:
    """Delivered or completed orders without a return request."""
    delivered = orders.filter(status_in("status", "Delivered", "Completed"))
    return absent_from(delivered, order_return, {"id": "order_id"})

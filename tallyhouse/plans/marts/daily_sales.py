"""Sales per day, province and channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, half_up, money, or_zero, status_is, total
from tallyhouse.plans.marts.shared import Tables, customer_places, order_lines


def daily_sales(tables: Tables, as_of: str | None = None) -> DataFrame:
    """One row per order day, province and channel.

    Items and returns are brought to order grain before the join, so an
    order with several lines counts once. Both aggregates come out
    partitioned by order id and join the orders without another shuffle of
    their own.
    """
    returns = tables["order_return"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("returns"), F.sum("refund_amount").alias("refunds")
    )
    orders = tables["orders"].select(
        F.col("id").alias("order_id"),
        "customer_id",
        F.to_date("order_date").alias("order_date"),
        "order_channel_id",
        "status",
        "total_price",
        "profit",
    )
    enriched = (
        orders.join(order_lines(tables), "order_id", "left")
        .join(returns, "order_id", "left")
        .join(customer_places(tables), "customer_id", "left")
    )
    return (
        enriched.groupBy("order_date", "province_name", "order_channel_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            total(F.sum("total_price")).alias("total_revenue"),
            total(F.sum("profit")).alias("total_profit"),
            F.sum("items_sold").alias("total_items_sold"),
            money(half_up(F.sum("total_price"), F.count("total_price"), 2)).alias("avg_order_value"),
            total(F.sum(or_zero("items_discount"))).alias("total_discount_amount"),
            count_where(status_is("status", "Completed")).alias("completed_orders"),
            count_where(status_is("status", "Cancelled")).alias("cancelled_orders"),
            count_where(status_is("status", "Returned")).alias("returned_orders"),
            F.sum(or_zero("returns")).alias("total_returns_count"),
            total(F.sum(or_zero("refunds"))).alias("total_refund_amount"),
        )
        .withColumn(
            "cancellation_rate",
            half_up(F.col("cancelled_orders"), F.col("total_orders"), 4).cast("double"),
        )
    )

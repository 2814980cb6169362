"""Shipment status effects, counters, dates and fees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import canonical, count_where, or_zero, status_in, status_is

# Fixed values of the shipping terms.
FREE_SHIPPING_ABOVE = 500_000
EXPRESS_MIN_FEE = 30_000
MAX_FAILED_ATTEMPTS = 3


def sync_orders(orders: DataFrame, shipment: DataFrame) -> DataFrame:
    """Order status that follows from the shipment status, and the attempt count.

    A cancelled or refunded order keeps its status; a delivered one does not
    go back to shipped. A failed delivery adds an attempt.
    """
    sent = shipment.select(
        F.col("id").alias("shipping_id"), "shipping_status", or_zero("delivery_attempts").alias("_attempts")
    )
    closed = status_in("status", "Cancelled", "Refunded")
    synced = (
        F.when(closed, canonical("status"))
        .when(status_is("shipping_status", "Delivered"), "DELIVERED")
        .when(status_is("shipping_status", "ReturnToSender"), "RETURNED")
        .when(status_is("shipping_status", "InTransit") & ~status_is("status", "Delivered"), "SHIPPED")
        .otherwise(canonical("status"))
    )
    failed = F.when(status_is("shipping_status", "Failed"), 1).otherwise(0)
    return (
        orders.select(F.col("id").alias("order_id"), "shipping_id", canonical("status").alias("status"))
        .join(sent, "shipping_id")
        .select(
            "order_id",
            "status",
            "shipping_status",
            synced.alias("synced_status"),
            (F.col("_attempts") + failed).alias("delivery_attempts"),
        )
    )


def shipment_counters(history: DataFrame) -> DataFrame:
    """Shipment state per order, folded from its status history with one aggregate."""
    status = canonical("status")
    shipped = F.max(F.when(status == "SHIPPED", F.col("changed_at")))
    failed = F.max(F.when(status == "DELIVERYFAILED", F.col("changed_at")))
    completed = F.max(F.when(status == "COMPLETED", F.col("changed_at")))
    return (
        history.groupBy("order_id")
        .agg(
            shipped.alias("last_shipped_at"),
            failed.alias("last_failed_at"),
            completed.alias("actual_delivery"),
            count_where(status == "DELIVERYFAILED").alias("delivery_attempts"),
        )
        .withColumn(
            "shipping_status",
            F.when(F.col("actual_delivery").isNotNull(), "Delivered")
            .when(
                F.col("last_failed_at").isNotNull()
                & (F.col("last_shipped_at").isNull() | (F.col("last_failed_at") >= F.col("last_shipped_at"))),
                "Failed",
            )
            .when(F.col("last_shipped_at").isNotNull(), "InTransit")
            .otherwise("Created"),
        )
    )


def expected_delivery(shipment: DataFrame, shipping_method: DataFrame) -> DataFrame:
    """Creation time plus the hours promised by the shipping method."""
    promised = shipping_method.select(
        F.col("id").alias("shipping_method_id"), F.col("estimated_delivery_time").alias("_hours")
    )
    return (
        shipment.join(promised, "shipping_method_id", "left")
        .withColumn("expected_delivery", F.col("created_at") + F.make_dt_interval(hours=F.col("_hours")))
        .drop("_hours")
    )


def shipping_terms(orders: DataFrame, shipment: DataFrame) -> DataFrame:
    """Fee after the free-shipping and express-minimum terms, and the return flag."""
    expedited = F.coalesce("is_expedited", F.lit(False))
    fee = (
        F.when(expedited, F.greatest(F.col("shipping_cost"), F.lit(EXPRESS_MIN_FEE)))
        .when(F.col("total_price") > FREE_SHIPPING_ABOVE, F.lit(0))
        .otherwise(F.col("shipping_cost"))
    )
    joined = orders.select(F.col("id").alias("order_id"), "shipping_id", "total_price").join(
        shipment.withColumnRenamed("id", "shipping_id"), "shipping_id"
    )
    return joined.select(
        "order_id",
        "is_expedited",
        fee.cast("decimal(18,2)").alias("fee"),
        return_to_sender(F.col("delivery_attempts")).alias("return_to_sender"),
    )


def return_to_sender(attempts: Column) -> Column:
    return attempts >= MAX_FAILED_ATTEMPTS

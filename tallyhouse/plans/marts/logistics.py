"""Shipping cost and punctuality per partner, method and province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, half_up, money, status_is, total
from tallyhouse.plans.marts.shared import Tables, customer_places


def shipment_times(shipment: DataFrame) -> DataFrame:
    """Seconds from creation to delivery and whether delivery kept its promise."""
    actual, promised = F.col("actual_delivery"), F.col("estimated_delivery")
    seconds = actual.cast("timestamp").cast("bigint") - F.col("created_at").cast("timestamp").cast("bigint")
    on_time = F.coalesce(actual <= promised, F.lit(False))
    return shipment.withColumns({"delivery_seconds": seconds, "is_on_time": on_time})


def logistics(tables: Tables, as_of: str | None = None) -> DataFrame:
    """One row per logistics partner, shipping method and customer province."""
    partners = tables["logistics_partner"].select(
        F.col("id").alias("logistics_partner_id"),
        F.col("name").alias("logistics_partner_name"),
        F.col("rating").alias("_rating"),
    )
    methods = tables["shipping_method"].select(
        F.col("id").alias("shipping_method_id"), F.col("name").alias("shipping_method_name")
    )
    shipments = (
        shipment_times(tables["shipment"])
        .join(partners, "logistics_partner_id", "left")
        .join(methods, "shipping_method_id", "left")
        .select(
            F.col("id").alias("shipping_id"),
            F.col("id").alias("_sent"),
            "logistics_partner_name",
            "shipping_method_name",
            "_rating",
            "shipping_cost",
            "is_expedited",
            "delivery_seconds",
            "is_on_time",
            "actual_delivery",
            "delivery_attempts",
            "shipping_status",
        )
    )
    sent = (
        tables["orders"]
        .select("shipping_id", "customer_id")
        .join(shipments, "shipping_id", "left")
        .join(customer_places(tables), "customer_id", "left")
    )
    delivered = F.count("actual_delivery")
    timed = F.count("delivery_seconds")
    return sent.groupBy("logistics_partner_name", "shipping_method_name", "province_name").agg(
        F.count("_sent").alias("total_shipments"),
        total(F.sum("shipping_cost")).alias("total_shipping_cost"),
        money(half_up(F.sum("shipping_cost"), F.count("shipping_cost"), 2)).alias("avg_shipping_cost"),
        half_up(F.sum("_rating"), F.count("_rating"), 2).cast("decimal(3,2)").alias("partner_rating"),
        half_up(count_where(F.col("is_expedited")) * 100, F.count(F.lit(1)), 2)
        .cast("decimal(5,2)")
        .alias("expedited_ratio"),
        half_up(F.sum("delivery_seconds"), timed * 3600, 2).cast("double").alias("avg_delivery_time_hours"),
        half_up(count_where(F.col("is_on_time")) * 100, delivered, 2)
        .cast("double")
        .alias("on_time_delivery_rate"),
        half_up(F.sum("delivery_attempts"), F.count("delivery_attempts"), 1)
        .cast("double")
        .alias("avg_delivery_attempts"),
        count_where(status_is("shipping_status", "Failed")).alias("failed_delivery_count"),
    )

"""Spend, returns, carts and activity per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, half_up, money, or_zero, status_is, total
from tallyhouse.plans.marts.shared import Tables, day, order_lines


def customer_analytics(tables: Tables, as_of: str) -> DataFrame:
    """One row per customer.

    Every fact is reduced to one row per customer before it meets the
    customers, so a customer with a large share of the rows is combined on
    the map side.
    """
    items = order_lines(tables).select("order_id", "items_sold")
    orders = (
        tables["orders"]
        .select(F.col("id").alias("order_id"), "customer_id", "total_price", F.to_date("order_date").alias("_day"))
        .join(items, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            total(F.sum("total_price")).alias("total_spent"),
            money(half_up(F.sum("total_price"), F.count("total_price"), 2)).alias("avg_order_value"),
            F.min("_day").alias("first_order_date"),
            F.max("_day").alias("last_order_date"),
            F.sum("items_sold").alias("total_items_purchased"),
        )
    )
    returns = tables["order_return"].groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_returns"), total(F.sum("refund_amount")).alias("total_refund_amount")
    )
    carts = tables["cart"].groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_carts_created"),
        count_where(status_is("status", "checked_out")).alias("total_carts_checked_out"),
    )
    activities = tables["customer_activity_log"].groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_activities")
    )
    places = tables["geo_location"].select(F.col("ward_code").alias("geo_location_id"), "province_name")
    joined = tables["customers"].select(
        F.col("id").alias("customer_id"), "name", "email", "phone", "tier", "loyalty_points", "geo_location_id"
    )
    for metrics in (orders, returns, carts, activities):
        joined = joined.join(metrics, "customer_id", "left")
    joined = joined.join(places, "geo_location_id", "left")
    return joined.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email",
        "phone",
        "province_name",
        "tier",
        "loyalty_points",
        "first_order_date",
        "last_order_date",
        or_zero("total_orders").alias("total_orders"),
        money(or_zero("total_spent")).alias("total_spent"),
        money(or_zero("avg_order_value")).alias("avg_order_value"),
        or_zero("total_items_purchased").alias("total_items_purchased"),
        or_zero("total_returns").alias("total_returns"),
        money(or_zero("total_refund_amount")).alias("total_refund_amount"),
        or_zero("total_carts_created").alias("total_carts_created"),
        or_zero("total_carts_checked_out").alias("total_carts_checked_out"),
        or_zero("total_activities").alias("total_activities"),
        F.datediff(day(as_of), "last_order_date").alias("days_since_last_order"),
    )

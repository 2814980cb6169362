"""Churn segment, engagement and cart behaviour per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.catalog import CART_STATUSES
from tallyhouse.functions import count_where, half_up, money, or_zero, status_is, sum_where, total
from tallyhouse.plans.marts.shared import Tables, day

# Longest silence in days per segment, shortest first.
SEGMENTS = (("Active", 30), ("At Risk", 90), ("Dormant", 180))

# Weight of each counted activity in the engagement score.
ENGAGEMENT_WEIGHTS = {
    "purchase_activity_count": 5,
    "add_to_cart_count": 3,
    "review_count": 3,
    "wishlist_activity_count": 2,
    "view_count": 1,
    "search_count": 1,
}

_ACTIVITY_COUNTS = {
    "view_count": "view",
    "search_count": "search",
    "add_to_cart_count": "add_to_cart",
    "purchase_activity_count": "purchase",
    "review_count": "review",
    "wishlist_activity_count": "wishlist",
}


def order_metrics(orders: DataFrame) -> DataFrame:
    ordered = F.to_date("order_date")
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total(F.sum("total_price")).alias("total_spent"),
        money(half_up(F.sum("total_price"), F.count("total_price"), 2)).alias("avg_order_value"),
        F.min(ordered).alias("first_order_date"),
        F.max(ordered).alias("last_order_date"),
        count_where(status_is("status", "Completed")).alias("completed_orders"),
        count_where(status_is("status", "Cancelled")).alias("cancelled_orders"),
        count_where(status_is("status", "Returned")).alias("returned_orders"),
        F.count_distinct(ordered).alias("distinct_order_dates"),
    )


def activity_metrics(activity: DataFrame) -> DataFrame:
    """Engagement counts per customer.

    Rows are first combined per customer, product and channel; the two
    distinct counts then run over that much smaller set.
    """
    combined = activity.groupBy("customer_id", "product_id", "channel").agg(
        F.count(F.lit(1)).alias("_all"),
        F.max(F.to_date("created_at")).alias("_last"),
        *[count_where(F.col("activity_type") == kind).alias(name) for name, kind in _ACTIVITY_COUNTS.items()],
    )
    return combined.groupBy("customer_id").agg(
        F.sum("_all").alias("total_activities"),
        *[F.sum(name).alias(name) for name in _ACTIVITY_COUNTS],
        F.count_distinct("product_id").alias("distinct_products_interacted"),
        F.count_distinct("channel").alias("distinct_channels_used"),
        F.max("_last").alias("last_activity_date"),
    )


def cart_metrics(cart: DataFrame) -> DataFrame:
    abandoned = status_is("status", "abandoned")
    return cart.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_carts"),
        *[count_where(status_is("status", name)).alias(f"{name}_carts") for name in CART_STATUSES],
        total(F.sum(or_zero("total_amount"))).alias("total_cart_value"),
        total(sum_where(abandoned, F.col("total_amount"))).alias("abandoned_cart_value"),
    )


def customer_retention(tables: Tables, as_of: str, activity_as_of: str | None = None) -> DataFrame:
    """One row per customer; activity recency may use its own day."""
    customers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("name").alias("customer_name"), "email", "tier", "loyalty_points"
    )
    joined = (
        customers.join(order_metrics(tables["orders"]), "customer_id", "left")
        .join(activity_metrics(tables["customer_activity_log"]), "customer_id", "left")
        .join(cart_metrics(tables["cart"]), "customer_id", "left")
    )
    counts = [
        "total_orders",
        "completed_orders",
        "cancelled_orders",
        "returned_orders",
        "distinct_order_dates",
        "total_activities",
        *_ACTIVITY_COUNTS,
        "distinct_products_interacted",
        "distinct_channels_used",
        "total_carts",
        "checked_out_carts",
        "abandoned_carts",
    ]
    amounts = ["total_spent", "avg_order_value", "abandoned_cart_value"]
    filled = joined.withColumns(
        {name: or_zero(name) for name in counts} | {name: money(or_zero(name)) for name in amounts}
    )
    silent = F.datediff(day(as_of), "last_order_date")
    segment = F.when(F.col("total_orders") == 0, "Never Purchased")
    for name, longest in SEGMENTS:
        segment = segment.when(silent <= longest, name)
    score = sum((F.col(name) * weight for name, weight in ENGAGEMENT_WEIGHTS.items()), F.lit(0))
    span = F.datediff("last_order_date", "first_order_date")
    return filled.select(
        "customer_id",
        "customer_name",
        "email",
        "tier",
        "loyalty_points",
        *counts,
        *amounts,
        "first_order_date",
        "last_order_date",
        "last_activity_date",
        silent.alias("days_since_last_order"),
        F.datediff(day(activity_as_of or as_of), "last_activity_date").alias("days_since_last_activity"),
        segment.otherwise("Churned").alias("churn_segment"),
        (F.col("total_orders") > 1).alias("is_repeat_customer"),
        F.when(F.col("total_orders") > 1, half_up(span, F.col("total_orders") - 1, 1))
        .cast("double")
        .alias("avg_days_between_orders"),
        F.when(F.col("total_carts") > 0, half_up(F.col("abandoned_carts") * 100, F.col("total_carts"), 2))
        .otherwise(0)
        .cast("double")
        .alias("cart_abandonment_rate"),
        score.alias("engagement_score"),
    )

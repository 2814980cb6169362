"""Review uniqueness and pairs that may still be reviewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import status_is
from tallyhouse.operators.skew import absent_from, salted_join
from tallyhouse.operators.validation import Rule, validate

KEY = ("product_id", "customer_id", "source_system")


def unique_reviews(reviews: DataFrame, order: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """Per product, customer and source: the first active review and how many follow it."""
    rest = [name for name in reviews.columns if name not in KEY and name not in order and name != "is_active"]
    return (
        reviews.filter("is_active")
        .groupBy(*KEY)
        .agg(F.min(F.struct(*order, *rest)).alias("_kept"), F.count(F.lit(1)).alias("_all"))
        .select(*KEY, "_kept.*", (F.col("_all") - 1).alias("rejected_reviews"))
    )


def validate_reviews(reviews: DataFrame) -> DataFrame:
    """Mark every active review but the first (lowest id) of its key as rejected."""
    active_id = F.when(F.col("is_active"), F.col("id"))
    per_key = reviews.groupBy(*KEY).agg(F.min(active_id).alias("_first_id"), F.count(F.lit(1)).alias("_rows"))
    judged = validate(
        salted_join(reviews, per_key.drop("_rows"), KEY, sizes=per_key),
        [Rule("already_reviewed", ~F.col("is_active") | (F.col("id") == F.col("_first_id")))],
    )
    return judged.drop("_first_id")


def reviewable_pairs(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct (customer, product) of completed orders that have no review yet."""
    completed = orders.filter(status_is("status", "Completed")).select(
        F.col("id").alias("order_id"), "customer_id"
    )
    bought = items.select("order_id", "product_id").join(completed, "order_id")
    pairs = bought.select("customer_id", "product_id").distinct()
    return absent_from(pairs, reviews, {"customer_id": "customer_id", "product_id": "product_id"})

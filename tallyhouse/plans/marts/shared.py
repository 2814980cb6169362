"""Pieces several marts use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def customer_places(tables: Tables) -> DataFrame:
    """customer_id with the province of its ward."""
    places = tables["geo_location"].select("ward_code", "province_name")
    buyers = tables["customers"].select(
        F.col("id").alias("customer_id"), F.col("geo_location_id").alias("ward_code")
    )
    return buyers.join(places, "ward_code", "left").drop("ward_code")


def warehouse_places(tables: Tables) -> DataFrame:
    places = tables["geo_location"].select("ward_code", "province_name")
    houses = tables["warehouse"].select(
        F.col("id").alias("warehouse_id"),
        F.col("name").alias("warehouse_name"),
        F.col("geo_location_id").alias("ward_code"),
    )
    return houses.join(places, "ward_code", "left").drop("ward_code")


def product_tree(tables: Tables, *columns: str) -> DataFrame:
    """product_id, product_name, the named product columns, sub-category and category."""
    branches = tables["sub_category"].select(
        F.col("id").alias("sub_category_id"), F.col("name").alias("sub_category_name"), "category_id"
    )
    roots = tables["category"].select(
        F.col("id").alias("category_id"), F.col("name").alias("category_name")
    )
    products = tables["product"].select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "sub_category_id", *columns
    )
    tree = branches.join(roots, "category_id", "left").drop("category_id")
    return products.join(tree, "sub_category_id", "left").drop("sub_category_id")


def items_per_order(items: DataFrame) -> DataFrame:
    """Item quantity and discount at order grain, so order money is counted once."""
    return items.groupBy("order_id").agg(
        F.sum("quantity").alias("items_sold"),
        F.sum(F.coalesce("discount_amount", F.lit(0))).alias("items_discount"),
    )


def order_lines(tables: Tables) -> DataFrame:
    """Order-grain item sums; a run that builds several marts may share them."""
    shared = tables.get("items_per_order")
    return items_per_order(tables["order_items"]) if shared is None else shared

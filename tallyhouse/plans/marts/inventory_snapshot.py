"""Stock per product and warehouse on the day of the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, or_zero, sum_where
from tallyhouse.plans.marts.shared import Tables, day, warehouse_places


def inventory_snapshot(tables: Tables, as_of: str) -> DataFrame:
    """One row per stock row, with its alerts and accumulated movements.

    Sales are reported as a positive quantity, like restocks.
    """
    change = F.col("quantity_change").cast("bigint")
    moved = tables["inventory_log"].groupBy(F.col("inventory_id").alias("id")).agg(
        sum_where(F.col("change_type") == "sale", F.abs(change)).alias("_sold"),
        sum_where(F.col("change_type") == "restock", change).alias("_restocked"),
    )
    products = tables["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    stock = (
        tables["inventory"]
        .join(moved, "id", "left")
        .join(products, "product_id", "left")
        .join(warehouse_places(tables), "warehouse_id", "left")
    )
    return stock.select(
        day(as_of).alias("snapshot_date"),
        "warehouse_name",
        "province_name",
        "product_id",
        "product_name",
        "quantity",
        "safety_stock",
        "reorder_level",
        money(F.col("quantity") * F.col("unit_cost")).alias("stock_value"),
        (F.col("quantity") <= F.col("reorder_level")).alias("is_low_stock"),
        (F.col("quantity") == 0).alias("is_out_of_stock"),
        or_zero("_sold").alias("total_sales_qty_accumulated"),
        or_zero("_restocked").alias("total_restock_qty_accumulated"),
    )

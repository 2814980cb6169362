"""Stock checks, allocation, change log, seeding and movement balances."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import or_zero
from tallyhouse.operators.sequence import clamped_balance, running_total
from tallyhouse.operators.skew import key_sizes, present_in, salted_join

# Fixed values of a seeded stock row.
SEED_SAFETY_STOCK = 10
SEED_REORDER_LEVEL = 20
# The source draws the cost between 60 % and 80 % of the price.
SEED_COST_FACTOR = Decimal("0.70")


def stock_by_product(inventory: DataFrame) -> DataFrame:
    """Per product: total stock and the fullest warehouse (lowest id on a tie)."""
    fullest = F.max(F.struct("quantity", (-F.col("id")).alias("_id"), "warehouse_id"))
    return (
        inventory.groupBy("product_id")
        .agg(F.sum("quantity").alias("total_stock"), fullest.alias("_top"))
        .select(
            "product_id",
            "total_stock",
            F.col("_top.quantity").alias("top_quantity"),
            (-F.col("_top._id")).alias("top_inventory_id"),
            F.col("_top.warehouse_id").alias("top_warehouse_id"),
        )
    )


def stock_check(items: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """Judge every line against product state and total stock."""
    offers = (
        product.select(F.col("id").alias("product_id"), F.col("is_active").alias("product_active"))
        .join(stock_by_product(inventory).select("product_id", "total_stock"), "product_id", "full")
    )
    enough = F.col("total_stock") >= F.col("quantity")
    return salted_join(items, offers, "product_id").withColumn(
        "reject_reason",
        F.when(~F.col("product_active"), "inactive_product").when(
            F.col("total_stock").isNull() | ~enough, "insufficient_stock"
        ),
    )


def allocate(items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Assign each line to the fullest warehouse that can serve it whole.

    Every line is judged against the opening stock. The fullest warehouse is
    enough to know: if it cannot serve the line, no other one can.
    """
    served = F.col("top_quantity") >= F.col("quantity")
    total_short = F.col("total_stock").isNull() | (F.col("total_stock") < F.col("quantity"))
    return (
        salted_join(items, stock_by_product(inventory), "product_id")
        .withColumn("inventory_id", F.when(served, F.col("top_inventory_id")))
        .withColumn("allocated_warehouse_id", F.when(served, F.col("top_warehouse_id")))
        .withColumn(
            "reject_reason",
            F.when(total_short, "insufficient_stock").when(~served, "no_single_warehouse"),
        )
        .drop("total_stock", "top_quantity", "top_inventory_id", "top_warehouse_id")
    )


def demand_cover(items: DataFrame, inventory: DataFrame, order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """Running demand per product in order of arrival against the opening stock."""
    demand = running_total(items, ["product_id"], order, "quantity", "running_demand")
    stock = stock_by_product(inventory).select("product_id", "total_stock")
    sizes = key_sizes(items, ["product_id"])
    return salted_join(demand, stock, "product_id", sizes=sizes).withColumn(
        "covered", F.col("running_demand") <= or_zero("total_stock")
    )


def change_log(before: DataFrame, after: DataFrame) -> DataFrame:
    """One log row per stock row whose quantity differs between two snapshots."""
    old = before.select(F.col("id").alias("inventory_id"), F.col("quantity").alias("quantity_before"))
    new = after.select(F.col("id").alias("inventory_id"), F.col("quantity").alias("quantity_after"))
    return (
        old.join(new, "inventory_id", "full")
        .withColumns({"quantity_before": or_zero("quantity_before"), "quantity_after": or_zero("quantity_after")})
        .filter(F.col("quantity_before") != F.col("quantity_after"))
        .withColumn("quantity_change", F.col("quantity_after") - F.col("quantity_before"))
        .withColumn("change_type", F.when(F.col("quantity_change") > 0, "restock").otherwise("sale"))
    )


def seed_gaps(product: DataFrame, warehouse: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per product: how many warehouses still lack a stock row, and the seed cost."""
    warehouses = warehouse.agg(F.count(F.lit(1))).scalar()
    stocked = (
        present_in(inventory, warehouse, {"warehouse_id": "id"})
        .groupBy("product_id")
        .agg(F.count_distinct("warehouse_id").alias("stocked_warehouses"))
    )
    return (
        product.select(F.col("id").alias("product_id"), "price")
        .join(stocked, "product_id", "left")
        .select(
            "product_id",
            or_zero("stocked_warehouses").alias("stocked_warehouses"),
            (warehouses - or_zero("stocked_warehouses")).alias("missing_warehouses"),
            (or_zero("price") * F.lit(SEED_COST_FACTOR)).cast("decimal(12,2)").alias("unit_cost"),
        )
    )


def movement_balance(
    log: DataFrame, order: tuple[str, ...] = ("created_at", "id"), opening: str = "opening_quantity"
) -> DataFrame:
    """Stock movements with a balance that is cut off at 0; no-op rows are dropped."""
    balanced = clamped_balance(log, ["inventory_id"], order, "quantity_change", opening)
    return balanced.filter(F.col("applied_change") != 0)


def stocked_warehouses(warehouse: DataFrame, inventory: DataFrame) -> DataFrame:
    """Warehouses that hold at least one stock row."""
    return present_in(warehouse, inventory, {"id": "warehouse_id"})

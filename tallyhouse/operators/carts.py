"""Cart items, totals, checkout, conversion and expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, money, or_zero, status_in, status_is
from tallyhouse.operators.customers import open_choices
from tallyhouse.operators.inventory import stock_by_product
from tallyhouse.operators.skew import salted_join
from tallyhouse.operators.validation import Rule, validate

# Fixed value: days without activity after which a cart expires.
IDLE_DAYS = 7


def cart_item_amounts(cart_items: DataFrame, product: DataFrame) -> DataFrame:
    """Price snapshot, amount, and rejection of discontinued products."""
    offers = product.select(
        F.col("id").alias("product_id"), F.col("price").alias("_price"), F.col("is_active").alias("_sold")
    )
    missing = F.col("unit_price").isNull() | (F.col("unit_price") == 0)
    priced = cart_items.join(offers, "product_id", "left").withColumn(
        "unit_price", F.when(missing, F.col("_price")).otherwise(F.col("unit_price"))
    )
    amount = F.col("unit_price") * F.col("quantity") - or_zero("discount_amount")
    judged = validate(priced.withColumn("amount", money(amount)), [Rule("inactive_product", F.col("_sold"))])
    return judged.drop("_price", "_sold")


def cart_totals(cart: DataFrame, cart_items: DataFrame) -> DataFrame:
    """Every cart with the total and number of its active items."""
    totals = (
        cart_items.filter("is_active")
        .groupBy(F.col("cart_id").alias("id"))
        .agg(F.sum("amount").alias("_total"), F.count(F.lit(1)).alias("_count"))
    )
    return (
        cart.join(totals, "id", "left")
        .withColumns({"total_amount": money(or_zero("_total")), "item_count": or_zero("_count")})
        .drop("_total", "_count")
    )


def validate_checkout(cart: DataFrame, cart_items: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """Judge whether each cart could be checked out now.

    It must be active, hold something, and every active item of a known
    product must be covered by the product's total stock.
    """
    stock = (
        product.select(F.col("id").alias("product_id"))
        .join(stock_by_product(inventory).select("product_id", "total_stock"), "product_id", "left")
        .withColumn("total_stock", or_zero("total_stock"))
    )
    active_items = cart_items.filter("is_active").select("cart_id", "product_id", "quantity")
    short = F.col("total_stock") < F.col("quantity")
    per_cart = (
        salted_join(active_items, stock, "product_id", "inner")
        .groupBy(F.col("cart_id").alias("id"))
        .agg(count_where(short).alias("short_items"))
    )
    return validate(
        cart.join(per_cart, "id", "left").withColumn("short_items", or_zero("short_items")),
        [
            Rule("not_active", status_is("status", "active")),
            Rule("empty_cart", F.col("item_count") > 0),
            Rule("insufficient_stock", F.col("short_items") == 0),
        ],
    )


def reactivation_allowed(old_status: Column | str, new_status: Column | str) -> Column:
    """A checked-out or expired cart never becomes active again."""
    return ~(status_in(old_status, "checked_out", "expired") & status_is(new_status, "active"))


def reactivations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Carts of the later version that must not be active again, with ``was`` and ``reject_reason``.

    Two versions of the cart table are compared by id. A cart that is only in one of them has not been reactivated.
    """
    was = before.select("id", F.col("status").alias("was"))
    both = after.join(was, "id")
    judged = validate(both, [Rule("reactivated", reactivation_allowed("was", "status"))])
    return judged.filter(F.col("reject_reason").isNotNull())


def addable_products(cart: DataFrame, cart_items: DataFrame, product: DataFrame) -> DataFrame:
    """Per active cart: number of active products not in it and the first of them."""
    owners = cart.filter(F.col("is_active") & status_is("status", "active"))
    return open_choices(owners, cart_items, "cart_id", product)


def convertible(cart: DataFrame) -> DataFrame:
    """Active carts with items and a positive total."""
    return cart.filter(
        F.col("is_active")
        & status_is("status", "active")
        & (F.col("item_count") > 0)
        & (F.col("total_amount") > 0)
    )


def orders_from_carts(cart: DataFrame, customers: DataFrame) -> DataFrame:
    """Pending order headers for every convertible cart."""
    buyers = customers.select(
        F.col("id").alias("customer_id"), F.col("geo_location_id").alias("location_id"), "order_channel_id"
    )
    return (
        convertible(cart)
        .select(F.col("id").alias("cart_id"), "customer_id", F.col("total_amount").alias("total_price"))
        .join(buyers, "customer_id", "left")
        .withColumn("status", F.lit("PENDING"))
    )


def items_from_carts(cart: DataFrame, cart_items: DataFrame) -> DataFrame:
    """Order lines copied from the active items of every convertible cart."""
    carts = convertible(cart).select(F.col("id").alias("cart_id"), "customer_id")
    lines = cart_items.filter("is_active").select(
        "cart_id", "product_id", "quantity", "unit_price", "discount_amount", "amount"
    )
    return lines.join(carts, "cart_id")


def expired_carts(cart: DataFrame, at: str) -> DataFrame:
    """Active carts idle for longer than the allowed days at the moment ``at``."""
    moment = F.lit(at).cast(cart.schema["updated_at"].dataType)
    return cart.filter(
        status_is("status", "active")
        & (F.col("updated_at") < moment - F.make_dt_interval(days=F.lit(IDLE_DAYS)))
    )

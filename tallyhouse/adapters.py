"""The retail tables derived from the generic test tables.

Each function returns one domain table as a projection, join or aggregate of
the parquet tables, with the column names of :mod:`tallyhouse.catalog`. The
formulas are described in FIXTURES.md. Timestamps stay ``timestamp_ntz`` so
that date filters still reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import money


def _choose(index: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), index.cast("int") + 1)


def _channel(number: Column) -> Column:
    return _choose(number % 4, "Shopee", "Lazada", "Tiki", "Website")


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _days(count: Column | int) -> Column:
    return F.make_dt_interval(days=(F.lit(count) if isinstance(count, int) else count).cast("int"))


OPENED = "1995-01-01"

# Columns of the test tables; declared, so opening a table runs no job.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Retail(Mapping):
    """Lazily built domain tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self._spark

    @property
    def folder(self) -> str:
        return self._folder

    def source(self, name: str) -> DataFrame:
        return self._spark.read.schema(SOURCES[name]).parquet(f"{self._folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = VIEWS[name](self)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def geo_location(r: Retail) -> DataFrame:
    nations, regions = r.source("nation"), r.source("region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("ward_code"),
        F.col("n_name").alias("province_name"),
        F.col("r_name").alias("region_name"),
    )


def customers(r: Retail) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    return r.source("customer").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), key.cast("string"), F.lit("@shop.example")).alias("email"),
        F.concat(F.lit("09"), F.lpad(key.cast("string"), 8, "0")).alias("phone"),
        F.col("c_nationkey").cast("bigint").alias("geo_location_id"),
        (key % 5 + 1).alias("order_channel_id"),
        F.col("c_mktsegment").alias("segment"),
        F.when(balance < 2500, "Bronze")
        .when(balance < 5000, "Silver")
        .when(balance < 7500, "Gold")
        .otherwise("Platinum")
        .alias("tier"),
        F.floor(F.abs(money(balance)) / 10).cast("int").alias("loyalty_points"),
        (balance >= 0).alias("is_active"),
        _moment(OPENED).alias("created_at"),
    )


def orders(r: Retail) -> DataFrame:
    key = F.col("o_orderkey")
    every_tenth = key % 10 == 0
    status = (
        F.when(F.col("o_orderstatus") == "F", F.when(every_tenth, "RETURNED").otherwise("COMPLETED"))
        .when(F.col("o_orderstatus") == "O", F.when(every_tenth, "CANCELLED").otherwise("DELIVERED"))
        .otherwise("PENDING")
    )
    total = money("o_totalprice")
    return r.source("orders").select(
        key.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        key.alias("payment_id"),
        key.alias("shipping_id"),
        F.when(key % 3 == 0, F.col("o_custkey") % 25).alias("discount_id"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("order_channel_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + _days(3)).alias("updated_at"),
        status.alias("status"),
        total.alias("total_price"),
        money(total * F.lit("0.30").cast("decimal(3,2)")).alias("profit"),
    )


def order_items(r: Retail) -> DataFrame:
    gross = money("l_extendedprice")
    discount = money(gross * F.col("l_discount").cast("decimal(4,2)"))
    each = (gross / F.col("l_quantity").cast("decimal(4,0)")).cast("decimal(12,2)")
    return r.source("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_linenumber") != 7, each).alias("unit_price"),
        gross.alias("gross"),
        discount.alias("discount_amount"),
        money(gross - discount).alias("amount"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
        F.col("l_shipdate").alias("created_at"),
    )


def _type_number(kind: Column) -> Column:
    order = ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")
    return F.array_position(F.array(*[F.lit(name) for name in order]), kind)


def product(r: Retail) -> DataFrame:
    return r.source("part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("brand_id"),
        _type_number(F.col("p_type")).alias("sub_category_id"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        (F.col("p_size") > 2).alias("is_active"),
    )


def brand(r: Retail) -> DataFrame:
    return (
        r.source("part")
        .groupBy("p_brand")
        .agg(F.count(F.lit(1)).alias("products"))
        .select(
            F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("id"), F.col("p_brand").alias("name")
        )
    )


def sub_category(r: Retail) -> DataFrame:
    sized = F.col("p_type").isin("SMALL", "MEDIUM", "LARGE")
    return (
        r.source("part")
        .select("p_type")
        .distinct()
        .select(
            _type_number(F.col("p_type")).alias("id"),
            F.col("p_type").alias("name"),
            F.when(sized, 1).otherwise(2).cast("bigint").alias("category_id"),
        )
    )


def category(r: Retail) -> DataFrame:
    return (
        sub_category(r)
        .select(F.col("category_id").alias("id"))
        .distinct()
        .withColumn("name", F.when(F.col("id") == 1, "SIZED").otherwise("GRADED"))
    )


def warehouse(r: Retail) -> DataFrame:
    return r.source("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("geo_location_id"),
        F.lit(True).alias("is_active"),
    )


def logistics_partner(r: Retail) -> DataFrame:
    return r.source("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        (F.col("s_suppkey") % 5 + 1).cast("decimal(3,2)").alias("rating"),
        F.lit(True).alias("is_active"),
    )


def _priorities(r: Retail) -> DataFrame:
    return r.source("orders").select("o_orderpriority").distinct()


def order_channel(r: Retail) -> DataFrame:
    return _priorities(r).select(
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id"),
        F.substring("o_orderpriority", 3, 30).alias("name"),
    )


def shipping_method(r: Retail) -> DataFrame:
    number = F.substring("o_orderpriority", 1, 1).cast("bigint")
    return _priorities(r).select(
        number.alias("id"),
        F.col("o_orderpriority").alias("name"),
        (number * 24).cast("int").alias("estimated_delivery_time"),
    )


def _inventory_id() -> Column:
    return F.col("l_partkey") * 100000 + F.col("l_suppkey")


def inventory(r: Retail) -> DataFrame:
    stock = (
        r.source("lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg((F.sum(F.col("l_quantity").cast("bigint")) % 101).cast("int").alias("quantity"))
    )
    prices = r["product"].select(F.col("id").alias("l_partkey"), "price")
    return stock.join(prices, "l_partkey", "left").select(
        _inventory_id().alias("id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        "quantity",
        F.lit(10).alias("safety_stock"),
        F.lit(20).alias("reorder_level"),
        (F.col("price") * F.lit("0.70").cast("decimal(3,2)")).cast("decimal(12,2)").alias("unit_cost"),
        F.lit(True).alias("is_active"),
    )


def inventory_log(r: Retail) -> DataFrame:
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    kind = (
        F.when(line == 7, "damage")
        .when(line == 6, "adjustment")
        .when(flag == "N", "sale")
        .when(flag == "A", "restock")
        .otherwise("return")
    )
    amount = F.col("l_quantity").cast("int")
    return r.source("lineitem").select(
        _inventory_id().alias("inventory_id"),
        kind.alias("change_type"),
        F.when(kind.isin("damage", "sale"), -amount).otherwise(amount).alias("quantity_change"),
        F.col("l_orderkey").alias("reference_id"),
        line.alias("line"),
        F.col("l_shipdate").alias("created_at"),
    )


def order_return(r: Retail) -> DataFrame:
    returned = (
        r["order_items"]
        .filter("rf = 'R'")
        .groupBy("order_id")
        .agg(money(F.sum("amount")).alias("refund_amount"), F.max("created_at").alias("created_at"))
    )
    buyers = r.source("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    key = F.col("order_id")
    return returned.join(buyers, "order_id").select(
        key.alias("id"),
        "order_id",
        "customer_id",
        F.concat(F.lit("reason_"), (key % 7).cast("string")).alias("reason"),
        _choose(key % 3, "refund", "exchange", "repair").alias("return_type"),
        _choose(key % 5, "pending", "approved", "rejected", "processing", "completed").alias("status"),
        "refund_amount",
        "created_at",
        F.when(key % 2 == 0, F.col("created_at") + _days(5)).alias("resolved_at"),
    )


def shipment(r: Retail) -> DataFrame:
    sent = (
        r.source("lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min("l_suppkey").alias("logistics_partner_id"),
            (F.sum(F.col("l_tax").cast("decimal(4,2)")) * 100).cast("decimal(12,2)").alias("shipping_cost"),
            F.max("l_shipdate").alias("actual_delivery"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    lines = F.coalesce("lines", F.lit(0))
    status = (
        F.when(lines == 0, "Created")
        .when(lines % 5 == 0, "Failed")
        .when(lines % 5 == 1, "InTransit")
        .when(lines % 7 == 0, "ReturnToSender")
        .otherwise("Delivered")
    )
    return r.source("orders").join(sent, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"),
        "logistics_partner_id",
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("shipping_method_id"),
        F.substring("o_orderpriority", 1, 1).isin("1", "2").alias("is_expedited"),
        "shipping_cost",
        status.alias("shipping_status"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + _days(60)).alias("estimated_delivery"),
        "actual_delivery",
        (lines % 3).cast("int").alias("delivery_attempts"),
    )


def customer_activity_log(r: Retail) -> DataFrame:
    kind = F.col("event_type")
    return r.source("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        F.when(kind == "click", "add_to_cart")
        .when(kind == "signup", "search")
        .when(kind == "error", "remove_from_cart")
        .otherwise(kind)
        .alias("activity_type"),
        (F.col("event_id") % 200).alias("product_id"),
        _channel(F.col("event_id")).alias("channel"),
        F.col("props").alias("metadata"),
        F.col("ts").alias("created_at"),
    )


def cart(r: Retail) -> DataFrame:
    return (
        r.source("events")
        .filter("event_type = 'click'")
        .select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customer_id"),
            _channel(F.col("event_id")).alias("channel"),
            _choose(
                (F.col("event_id") + F.col("user_id")) % 4, "active", "checked_out", "abandoned", "expired"
            ).alias("status"),
            F.col("value").cast("decimal(12,2)").alias("total_amount"),
            (F.col("event_id") % 5 + 1).cast("int").alias("item_count"),
            F.lit(True).alias("is_active"),
            F.col("ts").alias("created_at"),
            F.col("ts").alias("updated_at"),
            (F.col("ts") + _days(7)).alias("expires_at"),
        )
    )


def cart_items(r: Retail) -> DataFrame:
    lines = r["order_items"]
    return lines.select(
        F.col("order_id").alias("cart_id"),
        "product_id",
        "line",
        "quantity",
        F.when(F.col("line") == 6, F.lit(0)).otherwise(F.col("unit_price")).cast("decimal(12,2)").alias("unit_price"),
        "discount_amount",
        "amount",
        (F.col("rf") != "R").alias("is_active"),
        F.col("created_at").alias("added_at"),
    )


def product_review(r: Retail) -> DataFrame:
    buyers = r["orders"].select(F.col("id").alias("order_id"), "customer_id")
    source = F.when(F.col("ls") == "O", "Shopee").otherwise("Website")
    return (
        r["order_items"]
        .filter("rf = 'A'")
        .join(buyers, "order_id")
        .select(
            "product_id",
            "customer_id",
            (F.col("line") % 5 + 1).alias("rating"),
            source.alias("source_system"),
            "order_id",
            "line",
            F.lit(True).alias("is_active"),
            "created_at",
        )
    )


def wishlist(r: Retail) -> DataFrame:
    return (
        r.source("events")
        .filter(F.col("event_type").isin("view", "click"))
        .select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 200).alias("product_id"),
            (F.col("event_id") % 3 != 0).alias("is_active"),
            F.col("ts").alias("added_at"),
        )
    )


def discount(r: Retail) -> DataFrame:
    key = F.col("n_nationkey")
    start = _moment(OPENED) + _days(key * 90)
    return r.source("nation").select(
        key.cast("bigint").alias("id"),
        F.when(key % 2 == 0, "%").otherwise("fixed").alias("discount_type"),
        (key * 4).cast("decimal(12,2)").alias("value"),
        start.alias("start_date"),
        (start + _days(key + 30)).alias("end_date"),
        F.lit(True).alias("is_active"),
        (start + _days(key % 5 * 10)).alias("created_at"),
    )


def payment(r: Retail) -> DataFrame:
    return (
        r["order_items"]
        .groupBy(F.col("order_id").alias("id"))
        .agg(
            money(F.sum("gross")).cast("decimal(18,2)").alias("amount"),
            F.max(F.when(F.col("rf") == "A", "Completed").otherwise("Pending")).alias("payment_status"),
            F.min("created_at").alias("created_at"),
        )
    )


def order_status_history(r: Retail) -> DataFrame:
    """Placement of every order, then one padded mixed-case step per line."""
    placed = r["orders"].select(
        F.col("id").alias("order_id"),
        F.lit("Pending").alias("status"),
        F.col("order_date").alias("changed_at"),
        F.lit(0).alias("line"),
        F.lit(-1).cast("bigint").alias("product_id"),
    )
    step = F.concat("rf", "ls")
    status = (
        F.when(step == "NO", " Shipped ")
        .when(step == "NF", "Delivering")
        .when(step == "AO", "delivered ")
        .when(step == "AF", "Completed")
        .when(step == "RO", "DeliveryFailed")
        .otherwise("Cancelled")
    )
    steps = r["order_items"].select(
        "order_id", status.alias("status"), F.col("created_at").alias("changed_at"), "line", "product_id"
    )
    return placed.unionByName(steps)


def payment_history(r: Retail) -> DataFrame:
    status = F.when(F.col("rf") == "R", "Refunded").when(F.col("rf") == "A", "Completed").otherwise("Pending")
    return r["order_items"].select(
        F.col("order_id").alias("payment_id"),
        status.alias("payment_status"),
        money(F.col("gross") - 2000).alias("amount"),
        F.col("created_at").alias("changed_at"),
        "line",
        "product_id",
    )


VIEWS: dict[str, Callable[[Retail], DataFrame]] = {
    view.__name__: view
    for view in (
        geo_location,
        customers,
        orders,
        order_items,
        product,
        brand,
        sub_category,
        category,
        warehouse,
        logistics_partner,
        order_channel,
        shipping_method,
        inventory,
        inventory_log,
        order_return,
        shipment,
        customer_activity_log,
        cart,
        cart_items,
        product_review,
        wishlist,
        discount,
        payment,
        order_status_history,
        payment_history,
    )
}

"""Every registered query: a callable over the derived retail tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.adapters import SOURCES, Retail
from tallyhouse.catalog import TABLES
from tallyhouse.functions import status_is
from tallyhouse.operators import (
    activity,
    allocation,
    carts,
    constraints,
    customers,
    inventory,
    lifecycle,
    orders,
    payments,
    profiles,
    promotions,
    quality,
    returns,
    reviews,
    shipping,
    silver,
    validation,
)
from tallyhouse.plans import kpis
from tallyhouse.plans.marts import build
from tallyhouse.plans.marts.customer_retention import customer_retention as retention_mart
from tallyhouse.plans.marts.daily_sales import daily_sales as sales_mart
from tallyhouse.plans.marts.return_analysis import top_return_reasons as ranked_reasons
from tallyhouse.session import checkpoint_dir, tune
from tallyhouse.sources import filter_day, incremental, incremental_by_change, reassign_ids
from tallyhouse.streaming import cart_sessions, read_stream, stream_daily_activity, write_stream
from tallyhouse.streaming.deadlines import SECOND, Terms, due_by, stream_deadlines, with_timers
from tallyhouse.streaming.ingest import ingest_stream, ingested

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
STEP = ("changed_at", "line", "product_id")
ARRIVAL = ("created_at", "order_id", "line", "warehouse_id", "quantity")
MOVE = ("created_at", "reference_id", "line", "quantity_change")

QUERIES: dict[str, Callable[[Retail], DataFrame]] = {}


def query(function: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Money as double, dates and moments as text, so two engines' values compare."""

    def column(field: T.StructField):
        name = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return name.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(name, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return name

    return df.select(*[column(field) for field in df.schema.fields])


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, sf_dir: plain(function(Retail(tune(spark), sf_dir)))

    return {name: bind(function) for name, function in QUERIES.items()}


# Marts ---------------------------------------------------------------------


@query
def daily_sales(r: Retail) -> DataFrame:
    return build("daily_sales_mart", r, ORDERS_AS_OF)


@query
def daily_sales_by_channel(r: Retail) -> DataFrame:
    return kpis.sales_by_channel(sales_mart(r))


@query
def customer_analytics(r: Retail) -> DataFrame:
    return build("customer_analytics_mart", r, ORDERS_AS_OF)


@query
def product_performance(r: Retail) -> DataFrame:
    return build("product_performance_mart", r, ORDERS_AS_OF)


@query
def logistics(r: Retail) -> DataFrame:
    return build("logistics_mart", r, ORDERS_AS_OF)


@query
def inventory_snapshot(r: Retail) -> DataFrame:
    return build("inventory_snapshot_mart", r, ORDERS_AS_OF)


@query
def inventory_analysis(r: Retail) -> DataFrame:
    return build("inventory_analysis", r, ORDERS_AS_OF)


@query
def cart_analytics(r: Retail) -> DataFrame:
    return build("cart_analytics_mart", r, EVENTS_AS_OF)


@query
def customer_retention(r: Retail) -> DataFrame:
    return retention_mart(r, ORDERS_AS_OF, EVENTS_AS_OF)


@query
def return_analysis(r: Retail) -> DataFrame:
    return build("return_analysis", r, ORDERS_AS_OF)


@query
def top_return_reasons(r: Retail) -> DataFrame:
    return ranked_reasons(r["order_return"])


# KPIs ----------------------------------------------------------------------


@query
def kpi_orders(r: Retail) -> DataFrame:
    return kpis.order_kpis(r["orders"])


@query
def conversion_rate(r: Retail) -> DataFrame:
    return kpis.conversion_rate(r["orders"])


@query
def return_rate(r: Retail) -> DataFrame:
    return kpis.return_rate(r["orders"], r["order_return"])


@query
def kpi_customer_retention(r: Retail) -> DataFrame:
    return kpis.customer_retention_rate(r["customers"], r["orders"])


@query
def kpi_inventory_turnover(r: Retail) -> DataFrame:
    return kpis.inventory_turnover(r["inventory"], r["inventory_log"])


@query
def kpi_shipping_sla(r: Retail) -> DataFrame:
    return kpis.shipping_sla(r["shipment"])


@query
def kpi_carts(r: Retail) -> DataFrame:
    return kpis.cart_kpis(r["cart"])


# Extraction and cleaning ----------------------------------------------------


@query
def incremental_orders(r: Retail) -> DataFrame:
    return incremental(r["orders"], "created_at", "1998-01-05")


@query
def incremental_changed_orders(r: Retail) -> DataFrame:
    return incremental_by_change(r["orders"], "1998-01-05")


@query
def incremental_by_day(r: Retail) -> DataFrame:
    return filter_day(r["customer_activity_log"], "created_at", "2024-01-15")


@query
def reassigned_payment_ids(r: Retail) -> DataFrame:
    return reassign_ids(r["payment"])


@query
def silver_orders(r: Retail) -> DataFrame:
    return silver.clean("orders", r["orders"])


@query
def silver_order_items(r: Retail) -> DataFrame:
    return silver.clean_order_items(r["order_items"], ["line", "created_at", "warehouse_id"])


@query
def silver_default(r: Retail) -> DataFrame:
    return silver.clean("customer_activity_log", r["customer_activity_log"])


@query
def silver_geo(r: Retail) -> DataFrame:
    return silver.clean("geo_location", r["geo_location"])


@query
def silver_status_history(r: Retail) -> DataFrame:
    return silver.clean("order_status_history", r["order_status_history"])


@query
def silver_wishlist(r: Retail) -> DataFrame:
    return silver.clean("wishlist", r["wishlist"])


@query
def silver_cart_items(r: Retail) -> DataFrame:
    return silver.clean("cart_items", r["cart_items"])


@query
def backfilled_customers(r: Retail) -> DataFrame:
    return silver.backfill(r["customers"], "created_at", "2023-01-01").select("id", "created_at")


# Orders ----------------------------------------------------------------------


@query
def item_amount(r: Retail) -> DataFrame:
    priced = orders.item_amounts(r["order_items"], r["product"])
    return priced.select("order_id", "product_id", "line", "quantity", "unit_price", "discount_amount", "amount")


@query
def order_totals(r: Retail) -> DataFrame:
    return orders.order_totals(r["order_items"])


@query
def order_header_rollup(r: Retail) -> DataFrame:
    return orders.header_rollup(r["order_items"])


@query
def payment_sync(r: Retail) -> DataFrame:
    return orders.payment_sync(r["orders"], r["payment"], r["order_items"])


@query
def order_code(r: Retail) -> DataFrame:
    return orders.order_codes(r["orders"]).select("id", "order_code")


@query
def status_changes(r: Retail) -> DataFrame:
    return orders.status_changes(r["order_status_history"], STEP)


@query
def invalid_transitions(r: Retail) -> DataFrame:
    return orders.invalid_transitions(r["order_status_history"], STEP)


@query
def orders_without_items(r: Retail) -> DataFrame:
    return orders.orders_without_items(r["orders"], r["order_items"]).select("id", "customer_id", "order_date")


@query
def lifetime_spend(r: Retail) -> DataFrame:
    return orders.lifetime_spend(r["orders"])


@query
def overdue_orders(r: Retail) -> DataFrame:
    at = F.lit(ORDERS_AS_OF).cast("timestamp_ntz")
    return orders.cancel_overdue(r["orders"], at).select("id", "customer_id", "created_at")


# Inventory -------------------------------------------------------------------


@query
def stock_check(r: Retail) -> DataFrame:
    checked = inventory.stock_check(r["order_items"], r["product"], r["inventory"])
    return checked.select(
        "order_id", "product_id", "line", "warehouse_id", "quantity", "total_stock", "reject_reason"
    )


@query
def stock_allocation(r: Retail) -> DataFrame:
    return inventory.allocate(r["order_items"], r["inventory"]).select(
        "order_id", "product_id", "line", "quantity", "inventory_id", "allocated_warehouse_id", "reject_reason"
    )


@query
def stock_in_turn(r: Retail) -> DataFrame:
    served = allocation.allocate_in_turn(r["order_items"], r["inventory"], ARRIVAL)
    return served.select(
        "order_id", "product_id", "line", "warehouse_id", "quantity", "inventory_id", "allocated_warehouse_id", "reject_reason"
    )


@query
def remaining_stock(r: Retail) -> DataFrame:
    return allocation.remaining_stock(r["order_items"], r["inventory"], order=ARRIVAL)


@query
def stock_demand_cover(r: Retail) -> DataFrame:
    return inventory.demand_cover(r["order_items"], r["inventory"], ARRIVAL).select(
        "order_id", "product_id", "line", "warehouse_id", "quantity", "running_demand", "covered"
    )


def _stock_on(r: Retail, until: str) -> DataFrame:
    past = r["inventory_log"].filter(F.col("created_at") < F.lit(until).cast("timestamp_ntz"))
    return past.groupBy(F.col("inventory_id").alias("id")).agg(F.sum("quantity_change").alias("quantity"))


@query
def inventory_change_log(r: Retail) -> DataFrame:
    return inventory.change_log(_stock_on(r, "1998-01-01"), _stock_on(r, ORDERS_AS_OF))


@query
def stock_clamp(r: Retail) -> DataFrame:
    log = r["inventory_log"].withColumn("opening_quantity", F.lit(20))
    return inventory.movement_balance(log, MOVE).drop("opening_quantity")


@query
def inventory_seed(r: Retail) -> DataFrame:
    return inventory.seed_gaps(r["product"], r["warehouse"], r["inventory"])


@query
def stocked_warehouses(r: Retail) -> DataFrame:
    return inventory.stocked_warehouses(r["warehouse"], r["inventory"]).select("id", "name")


# Customers, payments, returns, reviews ---------------------------------------


@query
def customer_tier(r: Retail) -> DataFrame:
    return customers.customer_tiers(r["customers"], r["orders"])


@query
def customer_code(r: Retail) -> DataFrame:
    coded = customers.customer_codes(r["customers"], r["order_channel"])
    return coded.select("id", "order_channel_id", "customer_code", "email")


@query
def customers_without_cart(r: Retail) -> DataFrame:
    return customers.customers_without_cart(r["customers"], r["cart"]).select("id", "name")


@query
def wishlist_candidates(r: Retail) -> DataFrame:
    return customers.wishlist_candidates(r["customers"], r["wishlist"], r["product"])


@query
def payment_validation(r: Retail) -> DataFrame:
    return payments.validate_payments(r["payment_history"], STEP)


@query
def payment_effects(r: Retail) -> DataFrame:
    return payments.payment_effects(r["order_status_history"], r["orders"])


@query
def return_validation(r: Retail) -> DataFrame:
    judged = returns.validate_returns(r["order_return"], r["orders"])
    return judged.select("id", "order_id", "order_status", "order_total", "refund_amount", "reject_reason")


@query
def returnable_orders(r: Retail) -> DataFrame:
    return returns.returnable_orders(r["orders"], r["order_return"]).select("id", "customer_id", "total_price")


@query
def review_unique(r: Retail) -> DataFrame:
    return reviews.unique_reviews(r["product_review"], ("created_at", "order_id", "line"))


@query
def reviewable_pairs(r: Retail) -> DataFrame:
    return reviews.reviewable_pairs(r["orders"], r["order_items"], r["product_review"])


# Shipping and promotions -----------------------------------------------------


@query
def shipment_order_sync(r: Retail) -> DataFrame:
    return shipping.sync_orders(r["orders"], r["shipment"])


@query
def shipment_counters(r: Retail) -> DataFrame:
    return shipping.shipment_counters(r["order_status_history"])


@query
def expected_delivery(r: Retail) -> DataFrame:
    return shipping.expected_delivery(r["shipment"], r["shipping_method"]).select(
        "id", "shipping_method_id", "created_at", "expected_delivery"
    )


@query
def shipping_terms(r: Retail) -> DataFrame:
    return shipping.shipping_terms(r["orders"], r["shipment"])


@query
def discount_validation(r: Retail) -> DataFrame:
    return promotions.validate_discounts(r["discount"])


@query
def discounts_in_force(r: Retail) -> DataFrame:
    return promotions.discounts_in_force(r["orders"], r["discount"])


@query
def discount_timeline(r: Retail) -> DataFrame:
    timeline = promotions.discount_timeline(r["discount"])
    return timeline.withColumn("since", F.timestamp_micros("since"))


@query
def discounts_in_force_now(r: Retail) -> DataFrame:
    return promotions.in_force(r["discount"], "1996-04-10").select("id", "discount_type", "value")


@query
def discount_split(r: Retail) -> DataFrame:
    priced = orders.item_amounts(r["order_items"], r["product"])
    return promotions.discount_split(priced, r["orders"], r["discount"], r["order_items"]).select(
        "order_id", "product_id", "line", "quantity", "unit_price", "discount_type", "discount_amount", "amount"
    )


# Carts and activity ----------------------------------------------------------


@query
def cart_item_amount(r: Retail) -> DataFrame:
    return carts.cart_item_amounts(r["cart_items"], r["product"])


@query
def cart_totals(r: Retail) -> DataFrame:
    return carts.cart_totals(r["cart"], r["cart_items"]).select("id", "status", "total_amount", "item_count")


@query
def checkout_validation(r: Retail) -> DataFrame:
    filled = carts.cart_totals(r["cart"], r["cart_items"])
    return carts.validate_checkout(filled, r["cart_items"], r["product"], r["inventory"]).select(
        "id", "status", "item_count", "short_items", "reject_reason"
    )


@query
def reactivated_carts(r: Retail) -> DataFrame:
    """The carts against a later version in which every other one is active."""
    later = r["cart"].withColumn("status", F.when(F.col("id") % 2 == 0, "active").otherwise(F.col("status")))
    return carts.reactivations(r["cart"], later).select("id", "customer_id", "was", "status", "reject_reason")


@query
def addable_products(r: Retail) -> DataFrame:
    return carts.addable_products(r["cart"], r["cart_items"], r["product"])


@query
def cart_to_order(r: Retail) -> DataFrame:
    return carts.orders_from_carts(r["cart"], r["customers"])


@query
def cart_to_order_items(r: Retail) -> DataFrame:
    return carts.items_from_carts(r["cart"], r["cart_items"])


@query
def cart_expiry(r: Retail) -> DataFrame:
    return carts.expired_carts(r["cart"], EVENTS_AS_OF).select("id", "customer_id", "updated_at")


@query
def cart_activity_spans(r: Retail) -> DataFrame:
    touches = r["cart_items"].select("cart_id", F.col("added_at").alias("created_at"))
    return cart_sessions(touches, lateness=None)


@query
def activity_payload(r: Retail) -> DataFrame:
    return activity.typed_payload(r["customer_activity_log"], "k int").select("id", "activity_type", "k")


@query
def packed_payload(r: Retail) -> DataFrame:
    named = r["customer_activity_log"].withColumn("source", F.col("channel")).withColumn("quantity", F.col("product_id"))
    return activity.packed_payload(named).select("id", "activity_type", "metadata")


@query
def activity_daily_window(r: Retail) -> DataFrame:
    return activity.daily_activity(r["customer_activity_log"])


def _streamed(r: Retail, name: str, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``job`` as a stream over the event files and read what it appended."""
    spark = r.spark
    events = read_stream(spark, f"{r.folder}/events.parquet", SOURCES["events"])
    folder = f"{checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    result = job(events)
    write_stream(result, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/out")


@query
def activity_daily_stream(r: Retail) -> DataFrame:
    return _streamed(
        r,
        "activity",
        lambda events: stream_daily_activity(
            events.select(F.col("ts").alias("created_at"), F.col("event_type").alias("activity_type"))
        ),
    )


@query
def cart_session_stream(r: Retail) -> DataFrame:
    return _streamed(
        r,
        "carts",
        lambda events: cart_sessions(
            events.select(F.col("user_id").alias("cart_id"), F.col("ts").alias("created_at")), idle_days=1
        ),
    )


# Dates have no minutes here: 30 days to confirm, carts idle for a day.
TERMS = Terms(confirm=30 * 86_400 * SECOND, idle=86_400 * SECOND)


def _deadline_events(placed: DataFrame, lines: DataFrame, touches: DataFrame) -> DataFrame:
    """Orders, their steps and activity as events of one kind."""
    failed = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")

    def events(df: DataFrame, kind, number: str, event, at: str) -> DataFrame:
        named = [kind if not isinstance(kind, str) else F.lit(kind), event if not isinstance(event, str) else F.lit(event)]
        return df.select(named[0].alias("kind"), F.col(number).alias("id"), named[1].alias("event"), F.col(at).alias("created_at"))

    steps = events(
        lines, F.when(failed, "delivery").otherwise("order"), "l_orderkey", F.when(failed, "failed").otherwise("confirmed"), "l_shipdate"
    )
    return events(placed, "order", "o_orderkey", "placed", "o_orderdate").unionByName(steps).unionByName(
        events(touches, "cart", "user_id", "touch", "ts")
    )


@query
def due_deadlines(r: Retail) -> DataFrame:
    events = _deadline_events(*[r.source(name) for name in ("orders", "lineitem", "events")])
    until = r.source("events").agg((F.max("ts") - F.make_dt_interval(days=F.lit(1))).alias("until")).scalar()
    return due_by(events, until, TERMS)


@query
def deadline_stream(r: Retail) -> DataFrame:
    """The same decisions from a stream with timers."""
    parts = [read_stream(r.spark, f"{r.folder}/{name}.parquet", SOURCES[name]) for name in ("orders", "lineitem", "events")]
    decided = stream_deadlines(_deadline_events(*parts), TERMS)
    folder = f"{checkpoint_dir(r.spark)}/stream-deadlines-{uuid.uuid4().hex}"
    with with_timers(r.spark):
        running = write_stream(decided, f"{folder}/out", f"{folder}/state")
    running.awaitTermination()
    return r.spark.read.schema(decided.schema).parquet(f"{folder}/out")


@query
def ingested_activity(r: Retail) -> DataFrame:
    """Two versions of every event arrive as a stream; the later one is kept in its day, and a second run finds nothing new."""
    arrived = read_stream(r.spark, f"{r.folder}/events.parquet", SOURCES["events"])
    versions = [
        arrived.select(F.col("event_id").alias("id"), kind.alias("activity_type"), F.col("ts").alias("created_at"), F.lit(n).alias("version"))
        for n, kind in enumerate((F.lit("unknown"), F.col("event_type")))
    ]
    folder = f"{checkpoint_dir(r.spark)}/ingest-{uuid.uuid4().hex}"
    for _ in range(2):
        ingest_stream(versions[0].unionByName(versions[1]), folder, ["id"], "created_at", ["version"]).awaitTermination()
    return ingested(r.spark, folder).select("id", "activity_type", "version", "created_at_day")


# Quality, constraints, lifecycle ---------------------------------------------


@query
def constraint_check(r: Retail) -> DataFrame:
    return constraints.check_all(r, [name for name in r if name in TABLES])


@query
def dq_not_null_unique(r: Retail) -> DataFrame:
    return quality.not_null_unique(r["order_items"], "order_items", ORDERS_AS_OF, ["order_id", "product_id"])


@query
def dq_freshness(r: Retail) -> DataFrame:
    return quality.freshness(r["orders"], "orders", ORDERS_AS_OF)


@query
def dq_row_count(r: Retail) -> DataFrame:
    cleaned = silver.clean_order_items(r["order_items"], ["line", "created_at", "warehouse_id"])
    return quality.row_count_drift(r["order_items"], cleaned, "order_items", ORDERS_AS_OF)


@query
def dq_ref_integrity(r: Retail) -> DataFrame:
    return quality.references(r["cart_items"], "cart_items", EVENTS_AS_OF, "cart_id", r["cart"], "id")


@query
def dq_order_total(r: Retail) -> DataFrame:
    return quality.judge_order_totals(r["orders"], r["order_items"]).select(
        "id", "total_price", "items_total", "reject_reason"
    )


@query
def dq_missing_payment(r: Retail) -> DataFrame:
    return payments.delivered_without_payment(r["orders"], r["payment"]).select("id", "status", "total_price")


@query
def dq_discount_range(r: Retail) -> DataFrame:
    return quality.percent_range(r["discount"], ORDERS_AS_OF)


@query
def dq_pass_rate(r: Retail) -> DataFrame:
    judged = quality.judge_order_totals(r["orders"], r["order_items"])
    return validation.pass_rates(judged, "orders", ORDERS_AS_OF, quality.order_total_rules())


@query
def stored_profiles(r: Retail) -> DataFrame:
    """Months are profiled once and stored; the years' figures come from the stored rows."""
    columns = ["id", "customer_id", "status", "total_price", "order_date"]
    folder = f"{checkpoint_dir(r.spark)}/profiles-{uuid.uuid4().hex}"
    made = profiles.profile(r["orders"], "orders", F.date_trunc("month", "order_date"), columns)
    made.write.partitionBy("ds").parquet(folder)
    every = profiles.report(profiles.merged(r.spark.read.schema(made.schema).parquet(folder)))
    commonest = F.when(F.col("column_name") == "status", F.get("frequent", 0))
    return every.select(
        "table_name", "column_name", "rows", "nulls", "lowest", "highest",
        (F.col("distinct_values") >= (F.col("rows") - F.col("nulls")) * F.lit(profiles.UNIQUE_SHARE)).alias("looks_unique"),
        commonest["item"].alias("commonest"), commonest["count"].alias("commonest_rows"),
    )


@query
def stored_checks(r: Retail) -> DataFrame:
    """Verdicts of one day from stored profiles of the days around it."""
    days = r["customer_activity_log"].filter(F.col("created_at") < F.lit(EVENTS_AS_OF).cast("timestamp_ntz"))
    folder = f"{checkpoint_dir(r.spark)}/profiles-{uuid.uuid4().hex}"
    made = profiles.profile(days, "customer_activity_log", F.col("created_at"))
    made.write.partitionBy("ds").parquet(folder)
    return profiles.checks(r.spark.read.schema(made.schema).parquet(folder), TABLES["customer_activity_log"], "2024-01-20")


@query
def quarantine(r: Retail) -> DataFrame:
    judged = returns.validate_returns(r["order_return"], r["orders"])
    at = F.lit(ORDERS_AS_OF).cast("timestamp_ntz")
    return validation.quarantined(judged, at).select("id", "order_id", "refund_amount", "reject_reason", "rejected_at")


def _tiers_until(r: Retail, until: str) -> DataFrame:
    past = r["orders"].filter(F.col("order_date") < F.lit(until).cast("timestamp_ntz"))
    spent = orders.lifetime_spend(past)
    return spent.select(F.col("customer_id").alias("id"), customers.tier_of(F.col("total_spent")).alias("tier"))


@query
def scd2_customers(r: Retail) -> DataFrame:
    known = _tiers_until(r, "1998-01-01").select(
        "id",
        "tier",
        F.lit("1998-01-01").cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    recent = r["orders"].filter(
        status_is("status", "Completed") & (F.col("order_date") >= F.lit("1999-06-01").cast("timestamp_ntz"))
    )
    incoming = _tiers_until(r, ORDERS_AS_OF).join(
        recent.select(F.col("customer_id").alias("id")).distinct(), "id", "left_semi"
    )
    return lifecycle.scd2_merge(known, incoming, "id", ["tier"], ORDERS_AS_OF)


@query
def latest_by_key(r: Retail) -> DataFrame:
    return lifecycle.latest_by_key(r["order_status_history"], ["order_id"], STEP)


@query
def retention_filter(r: Retail) -> DataFrame:
    return lifecycle.keep_recent(r["orders"], "gold", ORDERS_AS_OF, "created_at").select("id", "created_at")

"""The retail tables: columns, keys, event time, extract mode, references.

Column names, types and allowed values are fixed values: they are the data
contract of the operational source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INCREMENTAL = "incremental"
SNAPSHOT = "snapshot"
# Incremental once a first load has taken all there is.
BACKFILLED = "backfilled"
BY_DAY = (INCREMENTAL, BACKFILLED)

_STAMPS = "created_at timestamp, updated_at timestamp"
_NAMED = f"id bigint, name string, description string, {_STAMPS}, is_active boolean"


@dataclass(frozen=True)
class Table:
    """One operational table and how it moves through the layers."""

    name: str
    ddl: str
    key: tuple[str, ...] = ("id",)
    event_time: str = "created_at"
    mode: str = SNAPSHOT
    # Silver is laid out by day of the event time unless a plain column is named.
    partition_column: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    # Rows of a log are written once and never again under the same key.
    append_only: bool = False
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


# Allowed texts of the status-like columns.
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
RETURN_TYPES = ("refund", "exchange", "repair")
RETURN_STATUSES = ("pending", "approved", "rejected", "processing", "completed")
CHANGE_TYPES = ("sale", "restock", "return", "adjustment", "damage")
REFERENCE_TYPES = ("order", "purchase_order", "return", "manual")
ACTIVITY_TYPES = (
    "view",
    "search",
    "add_to_cart",
    "remove_from_cart",
    "purchase",
    "review",
    "wishlist",
)
CART_STATUSES = ("active", "checked_out", "abandoned", "expired")

_TABLES = (
    Table(
        "orders",
        "id bigint, customer_id bigint, payment_id bigint, shipping_id bigint, discount_id bigint,"
        " location_id bigint, logistics_partner_id bigint, order_channel_id bigint, order_code string,"
        f" order_date timestamp, status string, is_active boolean, {_STAMPS},"
        " total_price decimal(11,2), profit decimal(12,2), notes string, confirmed_at timestamp,"
        " delivered_at timestamp, cancelled_at timestamp, cancel_reason string",
        mode=INCREMENTAL,
        unique=(("order_code",),),
        references={
            "customer_id": ("customers", "id"),
            "payment_id": ("payment", "id"),
            "shipping_id": ("shipment", "id"),
            "discount_id": ("discount", "id"),
            "location_id": ("geo_location", "ward_code"),
            "logistics_partner_id": ("logistics_partner", "id"),
            "order_channel_id": ("order_channel", "id"),
        },
    ),
    Table(
        "order_items",
        "id bigint, order_id bigint, product_id bigint, unit_price decimal(12,2),"
        " discount_amount decimal(12,2), quantity int, amount decimal(12,2), is_active boolean,"
        " created_at timestamp",
        references={"order_id": ("orders", "id"), "product_id": ("product", "id")},
        mode=BACKFILLED,
    ),
    Table("order_channel", _NAMED),
    Table(
        "order_status_history",
        "id bigint, order_id bigint, status string, changed_at timestamp, changed_by string,"
        " is_active boolean",
        event_time="changed_at",
        references={"order_id": ("orders", "id")},
        mode=BACKFILLED,
    ),
    Table(
        "product",
        "id bigint, product_sku string, brand_id bigint, name string, description string,"
        f" price decimal(12,2), sub_category_id bigint, {_STAMPS}, is_active boolean",
        references={"brand_id": ("brand", "id"), "sub_category_id": ("sub_category", "id")},
    ),
    Table(
        "product_review",
        "id bigint, product_id bigint, customer_id bigint, rating int, review_text string,"
        f" source_system string, {_STAMPS}, is_active boolean",
        references={"product_id": ("product", "id"), "customer_id": ("customers", "id")},
        domains={"rating": ("1", "2", "3", "4", "5")},
        mode=BACKFILLED,
    ),
    Table(
        "sub_category",
        f"id bigint, name string, description string, category_id bigint, {_STAMPS}, is_active boolean",
        references={"category_id": ("category", "id")},
    ),
    Table("category", _NAMED),
    Table(
        "discount",
        "id bigint, name string, discount_type string, value decimal(12,2), start_date timestamp,"
        " end_date timestamp, applies_to string, source_system string, is_active boolean,"
        f" {_STAMPS}",
    ),
    Table(
        "brand",
        f"id bigint, name string, country string, description string, is_active boolean, {_STAMPS}",
    ),
    Table(
        "payment",
        "id bigint, payment_method string, payment_status string, transaction_id string,"
        f" amount decimal(12,2), {_STAMPS}, is_active boolean",
        mode=BACKFILLED,
    ),
    Table(
        "shipment",
        "id bigint, logistics_partner_id bigint, warehouse_id bigint, is_expedited boolean,"
        " shipping_method_id bigint, tracking_number string, shipping_cost decimal(12,2),"
        f" shipping_status string, {_STAMPS}, is_active boolean, estimated_delivery timestamp,"
        " actual_delivery timestamp, delivery_attempts int",
        unique=(("tracking_number",),),
        references={"logistics_partner_id": ("logistics_partner", "id")},
        mode=BACKFILLED,
    ),
    Table(
        "logistics_partner",
        "id bigint, name string, created_at timestamp, rating decimal(3,2), updated_at timestamp,"
        " is_active boolean",
    ),
    Table(
        "shipping_method",
        "id bigint, name string, description string, estimated_delivery_time int, is_active boolean,"
        f" {_STAMPS}",
    ),
    Table(
        "customers",
        "id bigint, customer_code string, geo_location_id bigint, order_channel_id bigint,"
        " created_at timestamp, is_active boolean, name string, email string, phone string,"
        " tier string, total_spent decimal(15,2), loyalty_points int, last_order_date timestamp,"
        " updated_at timestamp",
        mode=INCREMENTAL,
        unique=(("customer_code",),),
        references={"geo_location_id": ("geo_location", "ward_code")},
        domains={"tier": TIERS},
    ),
    Table(
        "geo_location",
        "ward_code bigint, ward_name string, ward_type string, district_name string,"
        f" province_name string, {_STAMPS}, is_active boolean, is_before boolean",
        key=("ward_code",),
        partition_column="province_name",
    ),
    Table(
        "warehouse",
        "id bigint, name string, address string, geo_location_id bigint, capacity_sqm decimal(12,2),"
        f" manager string, contact_phone string, is_active boolean, {_STAMPS}",
        references={"geo_location_id": ("geo_location", "ward_code")},
    ),
    Table(
        "inventory",
        "id bigint, product_id bigint, warehouse_id bigint, quantity int, safety_stock int,"
        " reorder_level int, last_counted_at timestamp, unit_cost decimal(12,2), is_active boolean,"
        f" {_STAMPS}",
        unique=(("product_id", "warehouse_id"),),
        references={"product_id": ("product", "id"), "warehouse_id": ("warehouse", "id")},
    ),
    Table(
        "order_return",
        "id bigint, order_id bigint, customer_id bigint, reason string, return_type string,"
        f" status string, refund_amount decimal(12,2), is_active boolean, {_STAMPS},"
        " resolved_at timestamp",
        mode=INCREMENTAL,
        references={"order_id": ("orders", "id"), "customer_id": ("customers", "id")},
        domains={"return_type": RETURN_TYPES, "status": RETURN_STATUSES},
    ),
    Table(
        "inventory_log",
        "id bigint, inventory_id bigint, change_type string, quantity_change int,"
        " quantity_before int, quantity_after int, reference_id bigint, reference_type string,"
        " note string, changed_by string, created_at timestamp",
        mode=INCREMENTAL,
        append_only=True,
        references={"inventory_id": ("inventory", "id")},
        domains={"change_type": CHANGE_TYPES, "reference_type": REFERENCE_TYPES},
    ),
    Table(
        "customer_activity_log",
        "id bigint, customer_id bigint, activity_type string, product_id bigint, channel string,"
        " metadata string, created_at timestamp",
        mode=INCREMENTAL,
        append_only=True,
        references={"customer_id": ("customers", "id"), "product_id": ("product", "id")},
        domains={"activity_type": ACTIVITY_TYPES},
    ),
    Table(
        "wishlist",
        "id bigint, customer_id bigint, product_id bigint, added_at timestamp, is_active boolean",
        event_time="added_at",
        unique=(("customer_id", "product_id"),),
        references={"customer_id": ("customers", "id"), "product_id": ("product", "id")},
        mode=BACKFILLED,
    ),
    Table(
        "cart",
        "id bigint, customer_id bigint, channel string, status string, total_amount decimal(12,2),"
        " item_count int, expires_at timestamp, checked_out_at timestamp, order_id bigint,"
        f" is_active boolean, {_STAMPS}",
        mode=INCREMENTAL,
        references={"customer_id": ("customers", "id"), "order_id": ("orders", "id")},
        domains={"status": CART_STATUSES},
    ),
    Table(
        "cart_items",
        "id bigint, cart_id bigint, product_id bigint, quantity int, unit_price decimal(12,2),"
        " discount_amount decimal(12,2), amount decimal(12,2), added_at timestamp,"
        " updated_at timestamp, is_active boolean",
        event_time="added_at",
        unique=(("cart_id", "product_id"),),
        references={"cart_id": ("cart", "id"), "product_id": ("product", "id")},
        mode=BACKFILLED,
    ),
)

TABLES: dict[str, Table] = {table.name: table for table in _TABLES}


def table(name: str) -> Table:
    """Look a table up by name; an unknown name lists what exists."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(sorted(TABLES))}")
    return TABLES[name]

"""Raw to silver: one cleaning function per table, looked up by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import canonical, money

# Fixed value: the local zone of the business.
LOCAL_ZONE = "GMT+7"


def to_local(column: str) -> Column:
    return F.from_utc_timestamp(F.col(column).cast("timestamp"), LOCAL_ZONE)


def shift_all(df: DataFrame) -> DataFrame:
    """Move every source timestamp of a table to local time.

    They move together, so durations between two of them stay right. The
    pipeline's own stamps are left alone.
    """
    own = ("ingested_at", "processed_at")
    stamps = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)) and field.name not in own
    ]
    return df.withColumns({name: to_local(name) for name in stamps})


def with_lineage(df: DataFrame, source: str, run_id: str | None = None, version: str | None = None) -> DataFrame:
    """Where a row came from and when it was processed."""
    columns = {"processed_at": F.current_timestamp(), "_source_table": F.lit(source)}
    if run_id is not None:
        columns["_pipeline_run_id"] = F.lit(run_id)
    if version is not None:
        columns["_data_version"] = F.lit(version)
    return df.withColumns(columns)


def clean_geo(df: DataFrame) -> DataFrame:
    return df


def clean_orders(df: DataFrame) -> DataFrame:
    """Local time, two-decimal totals, canonical status; drops NULL and negative totals."""
    return (
        shift_all(df)
        .withColumns({"total_price": money("total_price"), "status": canonical("status")})
        .filter(F.col("total_price") >= 0)
    )


def clean_order_items(df: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Drops items without order or product and keeps one row per pair.

    The survivor is the first row by ``tie_break`` (default: id, or all other
    columns), so a rerun keeps the same row. Spark pushes the "first row"
    limit below the shuffle, so a pair repeated many times sends one row per
    task.
    """
    keys = ["order_id", "product_id"]
    typed = df.withColumns({"unit_price": money("unit_price"), "amount": money("amount")})
    rest = [name for name in typed.columns if name not in keys]
    order = list(tie_break) if tie_break else (["id"] if "id" in rest else rest)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return typed.dropna(subset=keys).withColumn("_place", place).filter("_place = 1").drop("_place")


def clean_status_history(df: DataFrame) -> DataFrame:
    return shift_all(df).withColumn("status", canonical("status"))


def clean_wishlist(df: DataFrame) -> DataFrame:
    return shift_all(df)


def clean_cart_items(df: DataFrame) -> DataFrame:
    return shift_all(df)


def clean_default(df: DataFrame) -> DataFrame:
    return shift_all(df)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": clean_orders,
    "order_items": clean_order_items,
    "geo_location": clean_geo,
    "order_status_history": clean_status_history,
    "wishlist": clean_wishlist,
    "cart_items": clean_cart_items,
}


def clean(table: str, df: DataFrame) -> DataFrame:
    return CLEANERS.get(table, clean_default)(df)


def backfill(df: DataFrame, column: str, value: str) -> DataFrame:
    """Set ``column`` to one constant on every row, in the column's own type."""
    kind = df.schema[column].dataType if column in df.columns else "timestamp"
    return df.withColumn(column, F.lit(value).cast(kind))

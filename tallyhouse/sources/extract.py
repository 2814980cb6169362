"""Extract modes: one day, everything, and the raw audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _day_range(df: DataFrame, column: str, ds: str) -> Column:
    """Half-open range over one day, typed like the column so it reaches the scan."""
    kind = df.schema[column].dataType
    start = F.lit(ds).cast("date")
    return (F.col(column) >= start.cast(kind)) & (F.col(column) < F.date_add(start, 1).cast(kind))


def incremental(df: DataFrame, column: str, ds: str) -> DataFrame:
    """Rows whose ``column`` falls on day ``ds``.

    Same rows as ``DATE(column) = ds``, written as a range so the parquet or
    JDBC source can skip data.
    """
    return df.filter(_day_range(df, column, ds))


def incremental_by_change(df: DataFrame, ds: str, updated: str = "updated_at", created: str = "created_at") -> DataFrame:
    """Rows created or last changed on day ``ds``, so later updates are not missed."""
    changed = _day_range(df, updated, ds)
    untouched = F.col(updated).isNull() & _day_range(df, created, ds)
    return df.filter(changed | untouched)


def snapshot(df: DataFrame) -> DataFrame:
    """The whole table, every run."""
    return df


def with_audit(df: DataFrame, ds: str) -> DataFrame:
    return df.withColumns({"ingested_at": F.current_timestamp(), "ingestion_date": F.lit(ds)})


def is_empty(df: DataFrame) -> bool:
    """True when nothing was extracted; stops at the first row found."""
    return df.isEmpty()


def batch(df: DataFrame, ds: str, column: str = "ingestion_date") -> DataFrame:
    """One ingestion batch; prunes partitions when the table is laid out by ``column``."""
    return df.filter(F.col(column) == F.lit(ds).cast(df.schema[column].dataType))


def filter_day(df: DataFrame, column: str, ds: str) -> DataFrame:
    """Rows of day ``ds`` whatever type ``column`` has.

    Text is compared as text and timestamps as a day range. Other types are
    compared by their text form, which for dates is the plain equality below.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return df.filter(F.col(column) == ds)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return incremental(df, column, ds)
    if isinstance(kind, T.DateType):
        return df.filter(F.col(column) == F.lit(ds).cast("date"))
    return df.filter(F.col(column).cast("string") == ds)

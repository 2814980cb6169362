"""One way to write a table: append, replace partitions, or replace the table."""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Mode(Enum):
    APPEND = "append"
    # Only partitions present in the new rows are replaced, so reloading a
    # day leaves the other days alone and never doubles that day.
    PARTITIONS = "partitions"
    # Everything is replaced: right for marts whose rows move between
    # partitions from one run to the next.
    TABLE = "table"


def namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def day_partition(df: DataFrame, event_time: str) -> DataFrame:
    """Add ``<event_time>_day`` for tables laid out by day."""
    return df.withColumn(f"{event_time}_day", F.to_date(event_time))


def write(
    df: DataFrame,
    path: str,
    mode: Mode = Mode.APPEND,
    partition_by: Sequence[str] = (),
    cluster: bool = True,
    sort_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Write parquet under ``path``.

    ``cluster`` gathers the rows of a partition before writing, which keeps
    the file count near the partition count. It is a rebalance, so AQE splits
    a partition that holds far more rows than the others over several tasks
    and files. ``sort_by`` orders rows inside each task, which lets readers
    skip row groups by their minimum and maximum.
    """
    if mode is Mode.PARTITIONS and not partition_by:
        raise ValueError("replacing partitions needs partition columns")
    if cluster and partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.option("compression", "zstd")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode is Mode.APPEND:
        writer = writer.mode("append")
    else:
        dynamic = "dynamic" if mode is Mode.PARTITIONS else "static"
        writer = writer.mode("overwrite").option("partitionOverwriteMode", dynamic)
    writer.parquet(path)

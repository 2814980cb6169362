"""Streaming ingest into day partitions, exactly once.

Each micro-batch is merged into the days that its rows belong to: the last version of every key stays, late rows
land in their own day, and all other days stay as they are. A batch goes through three steps, each of which may be
repeated: the merged days are staged, the day partitions are replaced by them, and the batch is
entered in the ledger. A batch that the ledger holds is passed over; one that broke off after staging goes on from
what was staged, so a half-replaced day is never merged from again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.lifecycle import latest_by_key
from tallyhouse.sinks import Mode, day_partition, write
from tallyhouse.sources.layers import drop_partition, exists, partition_values


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Batches that are in the table: ``batch, rows, days``."""
    schema = "rows bigint, days array<string>, batch bigint"
    if not exists(spark, f"{path}/ledger"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/ledger")


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now."""
    return spark.read.parquet(f"{path}/table")


def merge_batch(
    rows: DataFrame, batch: int, path: str, keys: Sequence[str], event_time: str, order: Sequence[str]
) -> None:
    """Merge one micro-batch into the table under ``path``; a batch that is in already changes nothing.

    ``order`` tells which of two rows of a key is the later one; a key's rows belong to one day of ``event_time``, since a day is
    merged by itself. Rows without the event time go to the day ``__HIVE_DEFAULT_PARTITION__`` of rows without a day.
    """
    spark = rows.sparkSession
    if batch in map(int, partition_values(spark, f"{path}/ledger", "batch")):
        return
    day, table, staged = f"{event_time}_day", f"{path}/table", f"{path}/staged/batch={batch}"
    if not exists(spark, f"{staged}/_SUCCESS"):
        new = day_partition(rows, event_time)
        merged = new
        if exists(spark, table):
            # Only days of this batch are read again: their list is one row a day.
            days = [row[0] for row in new.select(day).distinct().collect()]
            listed = F.col(day).isin([d for d in days if d is not None])
            old = spark.read.parquet(table).withColumn(day, F.col(day).cast("date"))
            old = old.filter(listed | F.col(day).isNull()) if None in days else old.filter(listed)
            merged = old.select(*new.columns).unionByName(new)
        write(latest_by_key(merged, keys, order), staged, Mode.TABLE, [day])
    days = partition_values(spark, staged, day)
    if days:
        whole = spark.read.option("basePath", staged).parquet(staged)
        write(whole, table, Mode.PARTITIONS, [day], cluster=False)
    entry = spark.createDataFrame([(spark.read.parquet(staged).count() if days else 0, days, batch)], "rows bigint, days array<string>, batch bigint")
    write(entry.coalesce(1), f"{path}/ledger", Mode.PARTITIONS, ["batch"], cluster=False)
    drop_partition(spark, f"{path}/staged", "batch", str(batch))


def ingest_stream(
    stream: DataFrame, path: str, keys: Sequence[str], event_time: str, order: Sequence[str], checkpoint: str | None = None
) -> StreamingQuery:
    """Merge what is available batch by batch, then stop."""

    def merge(rows: DataFrame, batch: int) -> None:
        merge_batch(rows, batch, path, keys, event_time, order)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint or f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )

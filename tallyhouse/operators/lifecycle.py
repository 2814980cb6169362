"""Current state, history, retention and file upkeep."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.sources.layers import (
    child_folders,
    drop_partition,
    exists,
    move,
    partition_values,
    read_text,
    remove,
    sized_files,
    write_text,
)

# Days kept per layer.
RETENTION_DAYS = {"raw": 30, "silver": 90, "gold": 365, "quarantine": 14}
# Fixed value: size a data file should reach.
TARGET_FILE_BYTES = 128 * 1024 * 1024


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``.

    The "first row" limit is applied before the shuffle as well, so a key
    with many versions sends one row per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(name) for name in order])
    return df.withColumn("_place", F.row_number().over(newest_first)).filter("_place = 1").drop("_place")


def scd2_merge(
    current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], ds: str, close_missing: bool = True
) -> DataFrame:
    """Next state of a versioned dimension after a full snapshot arrives.

    ``current`` has key, tracked columns, valid_from, valid_to and
    is_current. A changed key closes its open version at ``ds`` and opens a
    new one; a new key opens its first; a key missing from the snapshot is
    closed unless ``close_missing`` is off. Old versions pass through, so
    running the same snapshot again changes nothing.
    """
    day = F.lit(ds).cast("date")
    versions = [key, *tracked, "valid_from", "valid_to", "is_current"]
    old = current.filter("is_current").select(F.struct(*versions).alias("_old"), F.col(key).alias("_key"))
    new = incoming.select(F.struct(key, *tracked).alias("_new"), F.col(key).alias("_key"))
    both = old.join(new, "_key", "full")

    differs = F.lit(False)
    for name in tracked:
        differs = differs | ~F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))
    gone = F.col("_new").isNull() & F.lit(close_missing)
    changed = F.col("_new").isNotNull() & differs
    closing = gone | changed

    kept = F.struct(
        *[F.col(f"_old.{name}").alias(name) for name in [key, *tracked, "valid_from"]],
        F.when(closing, day).otherwise(F.col("_old.valid_to")).alias("valid_to"),
        (~closing).alias("is_current"),
    )
    opened = F.struct(
        *[F.col(f"_new.{name}").alias(name) for name in [key, *tracked]],
        day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), kept),
            F.when(F.col("_new").isNotNull() & (F.col("_old").isNull() | differs), opened),
        )
    )
    merged = both.select(F.inline(rows)).select(*versions)
    return merged.unionByName(current.filter("not is_current").select(*versions))


def keep_recent(df: DataFrame, layer: str, as_of: str, column: str) -> DataFrame:
    """Rows young enough for the retention of ``layer``; a range the scan can use."""
    oldest = F.date_sub(F.lit(as_of).cast("date"), RETENTION_DAYS[layer]).cast(df.schema[column].dataType)
    return df.filter(F.col(column) >= oldest)


def expire_partitions(spark: SparkSession, path: str, column: str, layer: str, as_of: str) -> list[str]:
    """Drop day partitions of a table past the retention of its layer.

    Works on the directory listing alone; no data is read. Returns the
    dropped values.
    """
    cutoff = (date.fromisoformat(as_of) - timedelta(days=RETENTION_DAYS[layer])).isoformat()
    expired = [value for value in partition_values(spark, path, column) if value < cutoff]
    for value in expired:
        drop_partition(spark, path, column, value)
    return expired


def packed(sizes: Mapping[str, int], target_bytes: int) -> list[list[str]]:
    """Files to put together, by first fit decreasing: bins of up to ``target_bytes``, each of two files or more.

    A file is never split, so one that fills a bin by itself, or finds no partner, stays as it is.
    """
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda entry: (-entry[1], entry[0])):
        for k, (held, names) in enumerate(bins):
            if held + size <= target_bytes:
                bins[k] = held + size, [*names, name]
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def compact(
    spark: SparkSession,
    path: str,
    column: str,
    target_bytes: int = TARGET_FILE_BYTES,
    sort_by: Sequence[str] = (),
) -> list[str]:
    """Put the small files of each partition together into files of up to ``target_bytes``; returns the partitions touched.

    Files are packed from the listing alone, and only files that are put together are read and written; all others keep their
    names. ``sort_by`` keeps the order that the table is written in. New files are written beside the table, entered in a
    journal, moved in, and only then the old ones go; a run that broke off in between is finished by the next one. For that
    moment a reader may meet rows twice.
    """
    finish_packing(spark, path)
    plan = {value: packed(sized_files(spark, path, column, value), target_bytes) for value in partition_values(spark, path, column)}
    plan = {value: bins for value, bins in plan.items() if bins}
    if not plan:
        return []
    # A row for each small file, as many as the listing has.
    listed, number = [], 0
    for value, bins in plan.items():
        for names in bins:
            listed += [(f"{column}={value}/{name}", number, value) for name in names]
            number += 1
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{file}" for file, _, _ in listed])
    place = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1).alias("_file")
    bins = F.broadcast(spark.createDataFrame([(file, k) for file, k, _ in listed], "_file string, _bin int"))
    own = [name for name in rows.columns if name != column]
    dealt = rows.select(*own, place).join(bins, "_file").drop("_file").repartition(number, "_bin")
    stage = f"{path}/{PACKING}{uuid.uuid4().hex}"
    dealt.sortWithinPartitions("_bin", *sort_by).write.option("compression", "zstd").partitionBy("_bin").parquet(stage)
    moves = []
    for value, names in plan.items():
        for files in names:
            k = len(moves)
            (made,) = sized_files(spark, stage, "_bin", str(k))
            moves.append([f"_bin={k}/{made}", f"{column}={value}/packed-{uuid.uuid4().hex}.parquet", [f"{column}={value}/{f}" for f in files]])
    write_text(spark, f"{stage}/{JOURNAL}", json.dumps(moves))
    finish_packing(spark, path)
    spark.catalog.refreshByPath(path)
    return sorted(plan)


PACKING, JOURNAL = "_packing-", "journal.json"


def finish_packing(spark: SparkSession, path: str) -> None:
    """Carry out what journals of earlier runs say; what was staged without a journal is dropped."""
    for name in child_folders(spark, path, PACKING):
        journal = f"{path}/{name}/{JOURNAL}"
        if exists(spark, journal):
            for made, target, old in json.loads(read_text(spark, journal)):
                if exists(spark, f"{path}/{name}/{made}"):
                    move(spark, f"{path}/{name}/{made}", f"{path}/{target}")
                for file in old:
                    remove(spark, f"{path}/{file}")
        remove(spark, f"{path}/{name}")

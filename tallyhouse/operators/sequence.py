"""Numbering, previous-row, last-value and running-balance jobs over long histories.

A window puts every row of a key into one task, which is right for the many
keys with a short history and wrong for a key that holds a large share of
the table. Hot keys are found by a sketch. Ordinary keys take the plain window, at
the cost of one shuffle. Hot keys are cut into ordered slices: the window
runs inside a slice, and what a slice carries into the next one comes from
an aggregate with one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.skew import heavy_hitters
from tallyhouse.session import materialise

# Rows of one key that a single task should still sort.
HOT_ROWS = 5_000_000


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pack the keys into one column that is never NULL itself.

    NULL is a key like any other here. A packed key lets windows,
    aggregates and joins all use the same plain equality, so they share one
    partitioning.
    """
    return df.withColumn("_key", F.struct(*keys) if keys else F.lit(0))


def dense_sequence(df: DataFrame, key: str, name: str, groups: Sequence[str] = ()) -> DataFrame:
    """Number rows 1, 2, 3 … by ``key`` within ``groups`` without one big sort.

    ``key`` must be unique within a group; a NULL comes first. Works like ``row_number`` over the
    groups, but rows are dealt out by ranges of (groups, key), so a handful of huge groups
    (or none at all), sparse keys or keys in clumps still use every task. A row's place in its range is known
    once the range is sorted; ranges are counted, and the counts of the ranges before are added.
    """
    groups = list(groups)
    dealt = _keyed(df, groups).repartitionByRange(*groups, key).sortWithinPartitions(*groups, key)
    # Written once: bounds of ranges come from a sample. The upper bits are the range, the lower 33 the row in it.
    rows = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_slice", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND((1 << 33) - 1))
    before = (Window.unboundedPreceding, -1)
    if not groups:
        # One row for each range, so a single small task adds them up and the sums may be broadcast.
        sizes = rows.groupBy("_slice").agg((F.max("_place") + 1).alias("_size"))
        start = F.coalesce(F.sum("_size").over(Window.orderBy("_slice").rowsBetween(*before)), F.lit(0))
        starts = F.broadcast(sizes.select("_slice", start.alias("_start")))
        numbered = rows.join(starts, "_slice")
    else:
        # A group lies in neighbouring ranges, and its rows in one range lie together.
        sizes = rows.groupBy("_key", "_slice").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
        earlier = F.sum("_size").over(Window.partitionBy("_key").orderBy("_slice").rowsBetween(*before))
        starts = sizes.select("_key", "_slice", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_start"))
        numbered = rows.join(starts, ["_key", "_slice"])
    return numbered.withColumn(name, F.col("_start") + F.col("_place") + 1).select(*df.columns, name)


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys (None when no key is hot).

    The list of hot keys is short by definition, see
    :func:`tallyhouse.operators.skew.heavy_hitters`, so it may be looked at here. Without any key
    the table is one history, which is cut like a hot key.
    """
    keys = list(keys)
    if not keys:
        return None, df
    found = [row["_hash"] for row in heavy_hitters(df, keys, hot_rows).collect()]
    if not found:
        return df, None
    is_hot = F.xxhash64(*keys).isin(found)
    return df.filter(~is_hot), df.filter(is_hot)


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number ordered slices of about equal size that cut through long keys.

    The range takes the order columns in, so one key spreads over as many
    slices as its rows need. Range bounds come from a sample, so the result
    is written once and read by every later step.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *keys, *order)
    return materialise(_keyed(ranged, keys).withColumn("_slice", F.spark_partition_id()))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Value of the row before, per key (``lag``); ``order`` must be a total order per key."""
    keys = list(keys)
    ordinary, hot = split_hot(df, keys, hot_rows)
    whole = Window.partitionBy(*keys).orderBy(*order)
    result = ordinary.withColumn(name, F.lag(value).over(whole))
    if hot is None:
        return result

    rows = _sliced(hot, keys, order)
    inside = Window.partitionBy("_key", "_slice").orderBy(*order)
    slices = Window.partitionBy("_key").orderBy("_slice")
    carried = (
        rows.groupBy("_key", "_slice")
        .agg(F.max_by(value, F.struct(*order)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(slices))
        .drop("_last")
    )
    local = rows.withColumn("_first", F.row_number().over(inside) == 1).withColumn(
        "_local", F.lag(value).over(inside)
    )
    joined = local.join(carried, ["_key", "_slice"]).withColumn(
        name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_local"))
    )
    return result.unionByName(joined.select(*result.columns))


def last_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last value that is not NULL, per key, the row's own included."""
    keys = list(keys)
    ordinary, hot = split_hot(df, keys, hot_rows)
    upto = (Window.unboundedPreceding, 0)
    result = None
    if ordinary is not None:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        result = ordinary.withColumn(name, F.last(value, ignorenulls=True).over(whole))
    if hot is None:
        return result

    rows = _sliced(hot, keys, order)
    inside = Window.partitionBy("_key", "_slice").orderBy(*order).rowsBetween(*upto)
    slices = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    valued = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_value")))
    carried = (
        rows.groupBy("_key", "_slice")
        .agg(F.max(valued)["_value"].alias("_last"))
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(slices))
        .drop("_last")
    )
    local = rows.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    joined = local.join(carried, ["_key", "_slice"]).withColumn(name, F.coalesce("_local", "_carried"))
    joined = joined.select(*df.columns, name)
    return joined if result is None else result.unionByName(joined)


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    since: str,
    columns: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each fact with the ``columns`` of the last version of its key that began by the fact's moment; NULL without any.

    Versions are laid among the facts in order of time, and the last one is carried on, so no range of moments
    is joined or expanded, and a key with a long history is cut into slices. ``(on, since)`` must be
    unique among versions. A NULL key or moment meets no version.
    """
    on = list(on)
    present = F.col(since).isNotNull()
    for key in on:
        present = present & F.col(key).isNotNull()
    kinds = [F.col(name).try_cast(facts.schema[name].dataType).alias(name) for name in on]
    begun = versions.filter(present).select(
        *kinds, F.col(since).cast(facts.schema[at].dataType).alias("_at"), F.lit(0).alias("_side"), F.struct(*columns).alias("_version")
    )
    asked = facts.withColumn("_at", F.col(at)).withColumn("_side", F.lit(1))
    every = begun.unionByName(asked, allowMissingColumns=True)
    found = last_value(every, on, ["_at", "_side"], "_version", "_found", hot_rows)
    valid = F.col("_at").isNotNull()
    for key in on:
        valid = valid & F.col(key).isNotNull()
    return found.filter("_side = 1").select(
        *facts.columns, *[F.when(valid, F.col("_found")[name]).alias(name) for name in columns]
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inclusive running sum per key over the whole history."""
    keys = list(keys)
    ordinary, hot = split_hot(df, keys, hot_rows)
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = ordinary.withColumn(name, F.sum(value).over(whole))
    if hot is None:
        return result

    rows = _sliced(hot, keys, order)
    inside = Window.partitionBy("_key", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    slices = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("_key", "_slice")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_carried", F.sum("_total").over(slices))
        .drop("_total")
    )
    local = rows.withColumn("_local", F.sum(value).over(inside))
    # NULL only before the first value of the key, as in one window.
    so_far = F.coalesce(F.col("_carried") + F.col("_local"), "_carried", "_local")
    joined = local.join(carried, ["_key", "_slice"]).withColumn(name, so_far)
    return result.unionByName(joined.select(*result.columns))


def _balance(df: DataFrame, change: str, unclamped: Column, low: Column, low_before: Column) -> DataFrame:
    """Balances from the unclamped sum and its lowest value up to and before each row."""
    floor, floor_before = F.least(F.lit(0), low), F.least(F.lit(0), low_before)
    return (
        df.withColumn("quantity_before", unclamped - F.col(change) - floor_before)
        .withColumn("quantity_after", unclamped - floor)
        .withColumn("applied_change", F.col("quantity_after") - F.col("quantity_before"))
    )


def clamped_balance(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    change: str,
    opening: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running balance that never goes below zero.

    Each row applies ``change`` to the balance and a shortfall is cut off at
    0. With S the unclamped running sum (starting from ``opening``), the
    clamped balance is ``S - min(0, lowest S so far)``, so two running
    aggregates replace the row-by-row fold.

    Adds quantity_before, quantity_after and applied_change.
    """
    keys = list(keys)
    ordinary, hot = split_hot(df, keys, hot_rows)
    columns = [*df.columns, "quantity_before", "quantity_after", "applied_change"]

    def sums(rows: DataFrame, window) -> DataFrame:
        upto = window.rowsBetween(Window.unboundedPreceding, 0)
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return (
            rows.withColumn("_sum", F.sum(change).over(upto))
            .withColumn("_low", F.min("_sum").over(upto))
            .withColumn("_low_before", F.min("_sum").over(before))
        )

    start = F.col(opening)
    plain = _balance(
        sums(ordinary, Window.partitionBy(*keys).orderBy(*order)),
        change,
        start + F.col("_sum"),
        start + F.col("_low"),
        start + F.col("_low_before"),
    ).select(*columns)
    if hot is None:
        return plain

    rows = _sliced(hot, keys, order)
    local = sums(rows, Window.partitionBy("_key", "_slice").orderBy(*order))
    slices = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        local.groupBy("_key", "_slice")
        .agg(F.sum(change).alias("_total"), F.min("_sum").alias("_slice_low"))
        .withColumn("_before", F.sum("_total").over(slices))
        .withColumn("_start", F.coalesce("_before", F.lit(0)))
        .withColumn("_carried_low", F.min(F.col("_start") + F.col("_slice_low")).over(slices))
        .drop("_total", "_slice_low")
    )
    base = start + F.col("_start")
    # A slice that begins with NULLs goes on with what came before it.
    so_far = F.coalesce(base + F.col("_sum"), start + F.col("_before"))
    carried_low = start + F.col("_carried_low")
    sliced = _balance(
        local.join(carried, ["_key", "_slice"]),
        change,
        so_far,
        F.least(carried_low, base + F.col("_low")),
        F.least(carried_low, base + F.col("_low_before")),
    ).select(*columns)
    return plain.unionByName(sliced)

"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition of a sort-merge join only when the shuffle sits
directly under the join, that is when both sides are scans or projections.
The helpers here cover the other shapes: a fact joined to an aggregate, and
anti or semi joins whose right side repeats a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows, whatever the size of its table: the limit is
# what one task should hold. A table of 10^12 rows has a million such keys at most.
HOT_ROWS = 1_000_000
# Tasks over which the rows of one hot key are spread.
SALTS = 64
# Keys that a list of hot keys holds at most, and keys that a sketch follows. A key with more than one row in
# some 3 000 is surely among them; one with less is no load for a task.
LISTED, TRACKED = 1024, 4096


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``_rows``; counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None
) -> DataFrame:
    """The hot keys of a table: one row for every ``hot_rows`` rows of it at most."""
    counted = key_sizes(df, keys) if sizes is None else sizes
    return counted.filter(F.col("_rows") > hot_rows).select(*keys)


def heavy_hitters(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes (``_hash``) of the keys that hold more than about ``hot_rows`` rows, ``LISTED`` at most.

    One pass that counts nothing exactly: every task keeps a space-saving sketch of bounded size, and sketches, not
    rows, are shuffled and merged in two steps. The list only steers how work is spread; results never depend on it.
    """
    name = f"approx_top_k_accumulate(xxhash64({', '.join(f'`{key}`' for key in keys)}), {TRACKED})"
    parts = df.groupBy((F.spark_partition_id() % SALTS).alias("_part")).agg(F.expr(name).alias("_sketch"))
    # Grouped by a constant: an empty table has no part, and a sketch of no parts cannot be made.
    top = parts.groupBy((F.col("_part") * 0).alias("_all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {TRACKED}), {LISTED})").alias("_top"))
    return top.select(F.inline("_top").alias("_hash", "_rows")).filter(F.col("_rows") > hot_rows).select("_hash")


def salted_join(
    fact: DataFrame,
    keyed: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a fact to one-row-per-key data, spreading the rows of hot keys.

    Only hot keys are salted: their fact rows get one of ``SALTS`` numbers
    and their ``keyed`` row is repeated once per number. All other keys join
    as they are. Rows without a key match nothing and are spread like hot ones.
    The salt is a hash of the fact row, so a retried task sends
    every row to the same place. ``sizes`` (keys and ``_rows``) saves the
    sketch when the caller has counted the keys already.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"salted_join keeps the fact side only, got {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if sizes is None:
        # At most LISTED rows.
        hot = F.broadcast(heavy_hitters(fact, keys, hot_rows).withColumn("_hot", F.lit(True)))
        # Hashes differ by type, so the other side's keys are hashed as the fact's.
        match, helper = ["_hash"], F.xxhash64(*[F.col(key).try_cast(fact.schema[key].dataType) for key in keys])
    else:
        # Spark broadcasts the list while it is small.
        hot = hot_keys(fact, keys, hot_rows, sizes).withColumn("_hot", F.lit(True))
        match, helper = keys, None

    def marked(df: DataFrame) -> DataFrame:
        df = df if helper is None else df.withColumn("_hash", helper)
        return df.join(hot, match, "left")

    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS)).cast("int")
    last = F.when(F.col("_hot"), SALTS - 1).otherwise(0)
    salted = marked(fact).withColumn("_salt", F.when(F.col("_hot") | keyless, salt).otherwise(0)).drop("_hot", "_hash")
    repeated = marked(keyed).withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_hot", "_hash")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _distinct_keys(right: DataFrame, pairs: dict[str, str]) -> DataFrame:
    return right.select(*[F.col(theirs).alias(f"_k_{ours}") for ours, theirs in pairs.items()]).distinct()


def _match(left: DataFrame, keys: DataFrame, pairs: dict[str, str]) -> Column:
    condition = None
    for ours in pairs:
        equal = left[ours] == keys[f"_k_{ours}"]
        condition = equal if condition is None else condition & equal
    return condition


def absent_from(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (NOT EXISTS).

    Right keys are made distinct first, on the map side as far as possible,
    so a key repeated many times on the right costs one row.
    """
    keys = _distinct_keys(right, pairs)
    return left.join(keys, _match(left, keys, pairs), "left_anti")


def present_in(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` (EXISTS)."""
    keys = _distinct_keys(right, pairs)
    return left.join(keys, _match(left, keys, pairs), "left_semi")

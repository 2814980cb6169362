"""Stored column profiles that merge: a day is scanned once, and any span of days is judged from its profiles.

A profile row holds what one column of one table looked like on one day: rows, NULLs, ends, and sketches of bounded size
for distinct values (HyperLogLog), quantiles (KLL) and frequent values. Counts add up, ends combine and sketches
merge, so uniqueness, freshness and drift over many days need no second look at the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.catalog import Table
from tallyhouse.operators.quality import FRESH_HOURS, MAX_DRIFT

# Values that the frequent-value sketch follows, and that a report names.
FOLLOWED, NAMED = 256, 5
# A column whose estimate reaches this share of its filled rows is taken to be unique; the sketch errs by about 2 %.
UNIQUE_SHARE = 0.95
# Days whose mean row count a day is compared with.
DRIFT_DAYS = 7

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_MOMENTS = (T.TimestampType, T.TimestampNTZType, T.DateType)
_SKETCHED = ("distinct", "quantiles", "frequent")


def _number(name: str, kind: T.DataType) -> Column:
    """A column as a number: moments count microseconds."""
    if isinstance(kind, _MOMENTS):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def _column(name: str, kind: T.DataType) -> Column:
    """Everything that is kept of one column, as one struct of aggregates."""
    ordered = isinstance(kind, (*_NUMBERS, *_MOMENTS))
    number = _number(name, kind) if ordered else F.lit(None).cast("double")
    text = F.col(name).cast("string")
    nothing = F.lit(None).cast("binary")
    return F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(name).isNull()).alias("nulls"),
        F.min(number).alias("lowest"),
        F.max(number).alias("highest"),
        F.hll_sketch_agg(text).alias("distinct"),
        (F.kll_sketch_agg_double(number) if ordered else nothing).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(cast(`{name}` as string), {FOLLOWED})").alias("frequent"),
    )


def profile(df: DataFrame, table: str, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per day and column, from one pass over ``df``; ``day`` tells a row's day.

    An empty table has no profile. A column without any value has a sketch of nothing.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    chosen = list(kinds) if columns is None else [name for name in columns if name in kinds]
    made = df.groupBy(F.date_format(day, "yyyy-MM-dd").alias("ds")).agg(
        *[_column(name, kinds[name]).alias(f"_c{k}") for k, name in enumerate(chosen)]
    )
    each = F.inline(F.array(*[F.col(f"_c{k}") for k in range(len(chosen))]))
    return made.select("ds", each).select(F.lit(table).alias("table_name"), "ds", "column_name", "rows", "nulls", "lowest", "highest", *_SKETCHED)


def merged(profiles: DataFrame) -> DataFrame:
    """Profiles of several days as one per table and column."""
    return profiles.groupBy("table_name", "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {FOLLOWED})").alias("frequent"),
    )


def report(profiles: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Profiles as figures: about how many values there are, quantiles, and the most frequent values."""
    top = F.expr(f"approx_top_k_estimate(frequent, {NAMED})")
    asked = F.array(*[F.lit(q).cast("double") for q in quantiles])
    # A sketch of nothing has no quantile.
    known = F.col("quantiles").isNotNull() & F.col("lowest").isNotNull()
    middle = F.when(known, F.kll_sketch_get_quantile_double("quantiles", asked))
    return profiles.select(
        *[c for c in ("table_name", "ds", "column_name", "rows", "nulls", "lowest", "highest") if c in profiles.columns],
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        middle.alias("quantiles"),
        top.alias("frequent"),
    )


def _rule(name: Column | str, passed: Column, failed: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(label.alias("rule"), passed.cast("bigint").alias("passed"), failed.cast("bigint").alias("failed"))


def checks(profiles: DataFrame, spec: Table, ds: str) -> DataFrame:
    """Rules of one table's day from stored profiles: ``table_name, rule, ds, passed, failed``.

    Filled key columns, keys of one column unique, event times within 48 hours of the day, and the day's rows within 5 % of
    the mean of up to seven days before; the first day is compared with nothing and passes. Freshness, uniqueness and
    drift judge a day as a whole: 1 passed or 1 failed.
    """
    own = profiles.filter((F.col("table_name") == spec.name) & (F.col("ds") <= ds))
    before = Window.partitionBy("column_name").orderBy("ds").rowsBetween(-DRIFT_DAYS, -1)
    # A row per day and column: a small table whatever the data.
    day = own.withColumn("_usual", F.avg("rows").over(before)).filter(F.col("ds") == ds)
    single = [key[0] for key in (spec.key, *spec.unique) if len(key) == 1]
    keys = sorted({name for key in (spec.key, *spec.unique) for name in key})
    column, filled = F.col("column_name"), F.col("rows") - F.col("nulls")
    unique = F.hll_sketch_estimate("distinct") >= filled * F.lit(UNIQUE_SHARE)
    oldest = F.unix_micros(F.lit(ds).cast("date").cast("timestamp") - F.make_dt_interval(hours=F.lit(FRESH_HOURS)))
    fresh = F.coalesce(F.col("highest") >= oldest, F.lit(False))
    steady = F.coalesce(F.abs(F.col("rows") - F.col("_usual")) < F.col("_usual") * F.lit(MAX_DRIFT), F.col("_usual").isNull())

    def verdict(holds: Column) -> tuple[Column, Column]:
        return holds.cast("bigint"), (~holds).cast("bigint")

    rules = F.array_compact(
        F.array(
            F.when(column.isin(keys), _rule(F.concat(F.lit("not_null("), column, F.lit(")")), filled, F.col("nulls"))),
            F.when(column.isin(single), _rule(F.concat(F.lit("unique("), column, F.lit(")")), *verdict(unique))),
            F.when(column == spec.event_time, _rule(f"fresh({spec.event_time})", *verdict(fresh))),
            F.when(column == spec.key[0], _rule("row_count", *verdict(steady))),
        )
    )
    judged = day.select("table_name", "ds", F.inline(rules))
    return judged.select("table_name", "rule", "ds", "passed", "failed")


def drift(profiles: DataFrame, first: Column, second: Column) -> DataFrame:
    """Two spans of days side by side, by column: shares of NULLs, medians, and about how many values are new.

    ``first`` and ``second`` are conditions on ``ds``. The values of the second span that the first lacks are what
    their union has more than the first alone.
    """
    def span(condition: Column, prefix: str) -> DataFrame:
        got = merged(profiles.filter(condition))
        known = F.col("quantiles").isNotNull() & F.col("lowest").isNotNull()
        median = F.when(known, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5).cast("double")))
        return got.select(
            "table_name", "column_name", F.col("rows").alias(f"{prefix}_rows"), (F.col("nulls") / F.col("rows")).alias(f"{prefix}_nulls"),
            median.alias(f"{prefix}_median"), F.col("distinct").alias(f"_{prefix}"),
        )

    both = span(first, "first").join(span(second, "second"), ["table_name", "column_name"], "full")
    grown = F.hll_sketch_estimate(F.hll_union("_first", "_second")) - F.hll_sketch_estimate("_first")
    return both.withColumn("new_values", grown).drop("_first", "_second")

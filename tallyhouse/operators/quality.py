"""Data quality checks; each returns table_name, rule, ds, passed, failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import money, or_zero, total
from tallyhouse.operators.constraints import check_reference
from tallyhouse.operators.validation import Rule, pass_rates, validate

# Fixed values of the quality contract.
FRESH_HOURS = 48
MAX_DRIFT = 0.05


def not_null_unique(df: DataFrame, table: str, ds: str, key: Sequence[str]) -> DataFrame:
    """Key columns are filled, and no key occurs twice in the batch."""
    columns = list(key)
    filled = [Rule(f"not_null({name})", F.col(name).isNotNull()) for name in columns]
    nulls = pass_rates(df, table, ds, filled)
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    unique = per_key.select(
        F.lit(table).alias("table_name"),
        F.lit(f"unique({','.join(columns)})").alias("rule"),
        F.lit(ds).alias("ds"),
        "_n",
    ).groupBy("table_name", "rule", "ds").agg(
        F.sum(F.when(F.col("_n") == 1, 1).otherwise(0)).alias("passed"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("failed"),
    )
    return nulls.unionByName(unique)


def freshness(df: DataFrame, table: str, ds: str, column: str = "created_at") -> DataFrame:
    """Rows no older than 48 hours before the batch day."""
    kind = df.schema[column].dataType
    oldest = F.lit(ds).cast("date").cast(kind) - F.make_dt_interval(hours=F.lit(FRESH_HOURS))
    fresh = F.coalesce(F.col(column) >= oldest, F.lit(False))
    return pass_rates(df, table, ds, [Rule(f"fresh({column})", fresh)])


def row_count_drift(source: DataFrame, target: DataFrame, table: str, ds: str) -> DataFrame:
    """Source and target row counts, their relative drift and the verdict."""
    tagged = source.select(F.lit(True).alias("_source")).unionAll(target.select(F.lit(False).alias("_source")))
    counted = tagged.agg(
        F.count_if("_source").alias("source_rows"), F.count_if(~F.col("_source")).alias("target_rows")
    )
    drift = F.abs(F.col("source_rows") - F.col("target_rows"))
    return counted.select(
        F.lit(table).alias("table_name"),
        F.lit(ds).alias("ds"),
        "source_rows",
        "target_rows",
        F.coalesce(drift < F.col("source_rows") * F.lit(MAX_DRIFT), F.lit(False)).alias("within_tolerance"),
    )


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Missing, unexpected and retyped columns, in the order of the expected schema."""
    have = {field.name: field.dataType for field in actual.fields}
    want = {field.name: field.dataType for field in expected.fields}
    found = [f"missing {name}" for name in want if name not in have]
    found += [f"unexpected {name}" for name in have if name not in want]
    found += [
        f"{name} is {have[name].simpleString()}, expected {kind.simpleString()}"
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    return found


def references(df: DataFrame, table: str, ds: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    checked = check_reference(df, table, column, parent, parent_key)
    return checked.select(
        "table_name",
        "rule",
        F.lit(ds).alias("ds"),
        (F.col("checked") - F.col("failed")).alias("passed"),
        "failed",
    )


def order_total_rules() -> list[Rule]:
    return [
        Rule("total_negative", F.col("total_price") >= 0),
        Rule("total_differs_from_items", F.col("total_price") == F.col("items_total")),
    ]


def judge_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders against the sum of their lines, with ``reject_reason``."""
    summed = items.groupBy(F.col("order_id").alias("id")).agg(total(F.sum("amount")).alias("items_total"))
    joined = orders.join(summed, "id", "left").withColumn("items_total", money(or_zero("items_total")))
    return validate(joined, order_total_rules())


def percent_range(discount: DataFrame, ds: str) -> DataFrame:
    percent = F.col("discount_type") == "%"
    return pass_rates(
        discount, "discount", ds, [Rule("percent_0_100", ~percent | F.col("value").between(0, 100))]
    )

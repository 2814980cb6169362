"""Row rules, quarantine and pass rates.

A rule fails only when its condition is definitely false: a NULL outcome
passes, as it does for a database CHECK.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column


def broken(rule: Rule) -> Column:
    return F.coalesce(~rule.holds, F.lit(False))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the broken rules in order, NULL for a good row."""
    reasons = F.concat_ws(",", *[F.when(broken(rule), F.lit(rule.name)) for rule in rules])
    return df.withColumn("reject_reason", F.when(reasons != "", reasons))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(validated: DataFrame, at: Column | None = None) -> DataFrame:
    """Rejected rows with their reason and the time of rejection."""
    return validated.filter(F.col("reject_reason").isNotNull()).withColumn(
        "rejected_at", F.current_timestamp() if at is None else at
    )


def pass_rates(df: DataFrame, table: str, ds: str, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows per rule, counted in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(broken(rule)).alias(rule.name) for rule in rules],
    )
    return counts.unpivot("_rows", [rule.name for rule in rules], "rule", "failed").select(
        F.lit(table).alias("table_name"),
        "rule",
        F.lit(ds).alias("ds"),
        (F.col("_rows") - F.col("failed")).alias("passed"),
        "failed",
    )

"""Key, reference and domain checks as one result row per check.

All checks of all tables share one pass: every row of a table is turned into one small entry for each key it
must not repeat, each reference it makes, each reference made to it, and each rule that it meets by itself. Entries are
grouped by check and key, and then by check. A table is read once, whatever the number of its checks, and entries of
one key combine on the map side, so a hot key costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.catalog import table as lookup

# The smallest number that a column may hold.
LEAST = {"inventory": {"quantity": 0}, "cart_items": {"quantity": 1}}


def _row(counts: DataFrame, table: str, rule: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.coalesce("checked", F.lit(0)).cast("bigint").alias("checked"),
        F.coalesce("failed", F.lit(0)).cast("bigint").alias("failed"),
    )


@dataclass(frozen=True)
class RowRule:
    """A rule that each row meets or fails by itself: which rows it judges, and which of them fail."""

    name: str
    judged: Column
    failed: Column


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null({column})", F.lit(True), F.col(column).isNull())


def domain(column: str, allowed: Iterable[str]) -> RowRule:
    return RowRule(f"domain({column})", F.col(column).isNotNull(), ~F.col(column).cast("string").isin(list(allowed)))


def at_least(column: str, least: int) -> RowRule:
    return RowRule(f"at_least({column},{least})", F.col(column).isNotNull(), F.col(column) < least)


def check_rows(df: DataFrame, table: str, rules: Iterable[RowRule]) -> DataFrame:
    """All row rules of a table in one pass, a result row for each."""
    rules = list(rules)
    counts = df.agg(
        *[F.count_if(rule.judged).alias(f"_checked_{k}") for k, rule in enumerate(rules)],
        *[F.count_if(rule.failed).alias(f"_failed_{k}") for k, rule in enumerate(rules)],
    )
    each = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule.name).alias("rule"),
            F.col(f"_checked_{k}").alias("checked"),
            F.col(f"_failed_{k}").alias("failed"),
        )
        for k, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*each)))


def check_unique(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Rows that repeat a key already seen; rows with a NULL key are exempt."""
    columns = list(columns)
    per_key = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_key.agg(F.sum("_n").alias("checked"), F.sum(F.col("_n") - 1).alias("failed"))
    return _row(counts, table, f"unique({','.join(columns)})")


def check_reference(df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent row."""
    per_key = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    parents = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_found", F.lit(True))
    missing = F.when(F.col("_found").isNull(), F.col("_n")).otherwise(0)
    counts = per_key.join(parents, "_key", "left").agg(
        F.sum("_n").alias("checked"), F.sum(missing).alias("failed")
    )
    return _row(counts, table, f"reference({column})")


@dataclass(frozen=True)
class Check:
    """One check: ``kind`` is unique, reference or row."""

    table: str
    rule: str
    kind: str


def _entry(check: int, key: str, n: str = "1L", failed: str = "0L", parent: str = "false") -> str:
    return f"named_struct('check', {check}, {key}, 'n', {n}, 'failed', {failed}, 'parent', {parent})"


NO_KEY = "'number', cast(null as bigint), 'second', cast(null as bigint), 'key', cast(null as string)"


def _whole(df: DataFrame, columns: Iterable[str]) -> bool:
    return all(isinstance(df.schema[column].dataType, T.IntegralType) for column in columns)


def _key(columns: Iterable[str], whole: bool) -> str:
    """Up to two whole numbers as they are; else the columns' text, each behind its length, so that different keys never look the same."""
    names = [f"`{column}`" for column in columns]
    if whole and len(names) <= 2:
        numbers = [f"cast({name} as bigint)" for name in names] + ["cast(null as bigint)"]
        return f"'number', {numbers[0]}, 'second', {numbers[1]}, 'key', cast(null as string)"
    texts = [f"cast({name} as string)" for name in names]
    text = texts[0] if len(texts) == 1 else f"concat({', '.join(f'length({name}), {chr(39)}:{chr(39)}, {name}' for name in texts)})"
    return f"'number', cast(null as bigint), 'second', cast(null as bigint), 'key', {text}"


def _filled(columns: Iterable[str]) -> str:
    return " and ".join(f"`{column}` is not null" for column in columns)


def _row_rules(df: DataFrame, name: str) -> list[RowRule]:
    rules = [domain(column, allowed) for column, allowed in lookup(name).domains.items() if column in df.columns]
    return rules + [at_least(column, least) for column, least in LEAST.get(name, {}).items() if column in df.columns]


def check_all(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Every declared key, reference and domain of the named tables that their columns allow.

    ``table_name, rule, checked, failed``: rows that a check judged, and those that fail it. Rows that repeat a key already seen
    fail it, rows with a NULL in a key are exempt; a NULL reference is not judged. An empty table has rows of zeros.
    """
    checks: list[Check] = []
    entries: dict[str, list[Column]] = {}

    def add(check: Check) -> int:
        checks.append(check)
        return len(checks) - 1

    def enter(table: str, condition: str, entry: str) -> None:
        entries.setdefault(table, []).append(F.expr(f"if({condition}, {entry}, null)"))

    for name in names:
        spec, df = lookup(name), tables[name]
        for key in (spec.key, *spec.unique):
            if set(key) <= set(df.columns):
                number = add(Check(name, f"unique({','.join(key)})", "unique"))
                enter(name, _filled(key), _entry(number, _key(key, _whole(df, key))))
        for column, (parent, parent_key) in spec.references.items():
            if column in df.columns and parent in tables:
                number = add(Check(name, f"reference({column})", "reference"))
                whole = _whole(df, [column]) and _whole(tables[parent], [parent_key])
                enter(name, _filled([column]), _entry(number, _key([column], whole)))
                enter(parent, _filled([parent_key]), _entry(number, _key([parent_key], whole), n="0L", parent="true"))
        for rule in _row_rules(df, name):
            number = add(Check(name, rule.name, "row"))
            entry = F.struct(
                F.lit(number).alias("check"),
                F.lit(None).cast("bigint").alias("number"),
                F.lit(None).cast("bigint").alias("second"),
                F.lit(None).cast("string").alias("key"),
                rule.judged.cast("int").cast("bigint").alias("n"),
                F.coalesce(rule.failed, F.lit(False)).cast("int").cast("bigint").alias("failed"),
                F.lit(False).alias("parent"),
            )
            entries.setdefault(name, []).append(entry)
    if not checks:
        raise ValueError("no check applies to these tables")
    spark = next(iter(tables.values())).sparkSession
    # An entry of nothing for every check, so that checks of empty tables are told as well.
    parts = [spark.range(len(checks)).select(F.expr(_entry(0, NO_KEY, n="0L")).withField("check", F.col("id").cast("int")).alias("e")).select("e.*")]
    for name, made in entries.items():
        parts.append(tables[name].select(F.inline(F.array(*made))).filter("check is not null"))
    every = reduce(DataFrame.unionByName, parts)
    per_key = every.groupBy("check", "number", "second", "key").agg(
        F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.max("parent").alias("parent")
    )
    per_check = per_key.groupBy("check").agg(
        F.sum("n").alias("checked"),
        F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("unique"),
        F.sum(F.when(F.col("parent"), 0).otherwise(F.col("n"))).alias("reference"),
        F.sum("failed").alias("row"),
    )

    def listed(values: Iterable[str]) -> Column:
        return F.element_at(F.array(*[F.lit(value) for value in values]), F.col("check") + 1)

    kind = listed(check.kind for check in checks)
    failed = F.when(kind == "unique", F.col("unique")).when(kind == "reference", F.col("reference")).otherwise(F.col("row"))
    return per_check.select(
        listed(check.table for check in checks).alias("table_name"),
        listed(check.rule for check in checks).alias("rule"),
        F.col("checked").cast("bigint").alias("checked"),
        failed.cast("bigint").alias("failed"),
    )


def check_table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """The checks of one table."""
    return check_all(tables, [name])

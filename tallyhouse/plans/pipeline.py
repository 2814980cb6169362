"""The daily run in one session: raw, silver, quarantine, gold.

Every step is a plain function over paths, so a scheduler can call them one
by one; :func:`run_day` calls them in dependency order. Reloading a day
replaces that day and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.catalog import BACKFILLED, BY_DAY, TABLES, table as lookup
from tallyhouse.operators.lifecycle import latest_by_key, scd2_merge
from tallyhouse.operators.profiles import checks, profile
from tallyhouse.operators.quality import schema_differences
from tallyhouse.operators.sequence import asof_join
from tallyhouse.operators.silver import clean, with_lineage
from tallyhouse.operators.validation import Rule, accepted, quarantined, validate
from tallyhouse.plans.marts import MARTS, mart
from tallyhouse.plans.marts.shared import items_per_order
from tallyhouse.session import materialise, tune
from tallyhouse.sinks import Mode, write
from tallyhouse.sources import (
    batch,
    drop_partition,
    filter_day,
    incremental_by_change,
    is_empty,
    layer_path,
    partition_values,
    read_layer,
    with_audit,
)

# Marts that start from the order-grain item sums.
SHARE_ITEMS = {"daily_sales_mart", "customer_analytics_mart"}


def extract(name: str, source: DataFrame, ds: str, first: bool = False) -> DataFrame:
    """One table's rows for the batch: the day for facts, everything otherwise.

    A fact whose history has to be there from the start is taken whole by the ``first`` load.
    """
    spec = lookup(name)
    if spec.mode not in BY_DAY or (first and spec.mode == BACKFILLED):
        return source
    if "updated_at" in source.columns:
        return incremental_by_change(source, ds, "updated_at", spec.event_time)
    return filter_day(source, spec.event_time, ds)


def load_raw(name: str, source: DataFrame, root: str, ds: str, strict: bool = False) -> bool:
    """Extract into the raw layer by ingestion date; False when there was nothing.

    A day that was loaded before and is empty now loses its rows. ``strict`` refuses a source that lacks a column of the
    catalog or has one of another type.
    """
    loaded = partition_values(source.sparkSession, layer_path(root, "raw", name), "ingestion_date")
    missing = schema_differences(source.schema, lookup(name).schema)
    strange = [text for text in missing if " is " in text or text.startswith("missing ")]
    if strange and strict:
        raise ValueError(f"{name} does not fit its schema: {'; '.join(strange)}")
    rows = extract(name, source, ds, first=all(day >= ds for day in loaded))
    if is_empty(rows):
        clear_day(rows.sparkSession, layer_path(root, "raw", name), ds)
        return False
    write(
        with_audit(rows, ds), layer_path(root, "raw", name), Mode.PARTITIONS, ["ingestion_date"], cluster=False
    )
    return True


def clear_day(spark: SparkSession, path: str, ds: str) -> None:
    """Remove a day's partition; replacing partitions by no rows would leave it."""
    if ds in partition_values(spark, path, "ingestion_date"):
        drop_partition(spark, path, "ingestion_date", ds)


def key_rules(name: str) -> list[Rule]:
    return [Rule(f"null_{key}", F.col(key).isNotNull()) for key in lookup(name).key]


def load_silver(
    spark: SparkSession,
    name: str,
    root: str,
    ds: str,
    rules: Iterable[Rule] | None = None,
    run_id: str | None = None,
    version: str | None = None,
) -> None:
    """Clean one raw batch; rejected rows go to quarantine with their reason."""
    spec = lookup(name)
    raw = batch(read_layer(spark, root, "raw", name), ds)
    rules = list(rules) if rules is not None else key_rules(name)
    judged = validate(raw, rules)
    cleaned = with_lineage(clean(name, accepted(judged)), f"raw.{name}", run_id, version)
    order = spec.partition_column or spec.event_time
    by_order = [order] if order in cleaned.columns else ()
    for rows, layer, sort_by in ((cleaned, "silver", by_order), (quarantined(judged), "quarantine", ())):
        path = layer_path(root, layer, name)
        if is_empty(rows):
            clear_day(spark, path, ds)
        else:
            write(rows, path, Mode.PARTITIONS, ["ingestion_date"], cluster=False, sort_by=sort_by)


# Dimensions that keep their versions, and the columns whose change makes one.
VERSIONED = {"customers": ("tier", "geo_location_id", "is_active")}


def versions(spark: SparkSession, name: str, root: str, ds: str | None = None) -> DataFrame | None:
    """Versions of a dimension as they were known on a day, or now; None before its first load."""
    path = layer_path(root, "silver", f"{name}_versions")
    days = [day for day in partition_values(spark, path, "as_of") if ds is None or day <= ds]
    if not days:
        return None
    return batch(spark.read.parquet(path), days[-1], "as_of").drop("as_of")


def load_versions(spark: SparkSession, name: str, root: str, ds: str) -> None:
    """Bring a dimension's versions up to the day; the state of earlier days stays, so a day can be loaded again.

    A customer that changed closes its open version and opens the next one. A table that is extracted by change holds only what
    changed, so a key that is absent stays open.
    """
    spec = lookup(name)
    (key,) = spec.key
    view = silver_view(spark, name, root, ds)
    tracked = [c for c in VERSIONED[name] if c in view.columns]
    path = layer_path(root, "silver", f"{name}_versions")
    earlier = [day for day in partition_values(spark, path, "as_of") if day < ds]
    if earlier:
        known = batch(spark.read.parquet(path), earlier[-1], "as_of").drop("as_of")
    else:
        known = spark.createDataFrame([], view.select(key, *tracked).schema).withColumns(
            {"valid_from": F.lit(None).cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
        )
    state = scd2_merge(known, view, key, tracked, ds, close_missing=False)
    write(state.withColumn("as_of", F.lit(ds)), path, Mode.PARTITIONS, ["as_of"], cluster=False, sort_by=[key])


def with_version(facts: DataFrame, history: DataFrame, key: str, dimension_key: str, at: str, columns: Iterable[str]) -> DataFrame:
    """Facts with the ``columns`` of the version of their dimension row that was valid at the fact's moment.

    An as-of join: a version counts from its first day on until it is closed. Facts before the first version have none.
    """
    columns = list(columns)
    named = {name: f"_v_{name}" for name in columns}
    since = history.select(
        F.col(dimension_key).alias(key), F.col("valid_from").alias("_since"), F.col("valid_to").alias("_until"), *[F.col(c).alias(n) for c, n in named.items()]
    )
    joined = asof_join(facts, since, [key], at, "_since", ["_until", *named.values()])
    valid = F.col("_until").isNull() | (F.col(at) < F.col("_until").cast(facts.schema[at].dataType))
    return joined.select(*facts.columns, *[F.when(valid, F.col(n)).alias(f"{c}_then") for c, n in named.items()])


def silver_view(spark: SparkSession, name: str, root: str, ds: str | None = None) -> DataFrame:
    """Rows of a silver table as of a day, or now: the last version of every key ingested by then.

    Snapshot tables repeat in full each day, so for them only the newest
    batch is read; its day comes from the directory listing. A log never gets
    a second version of a row and is read as it is. A table that
    has not been loaded by then is empty.
    """
    spec = lookup(name)
    days = partition_values(spark, layer_path(root, "silver", name), "ingestion_date")
    days = [day for day in days if ds is None or day <= ds]
    if not days:
        return spark.createDataFrame([], spec.schema)
    rows = read_layer(spark, root, "silver", name)
    if spec.mode in BY_DAY:
        rows = rows.where(F.col("ingestion_date") <= F.lit(days[-1]).cast(rows.schema["ingestion_date"].dataType))
        if spec.append_only:
            return rows
        return latest_by_key(rows, spec.key, ["ingestion_date", "processed_at"])
    return batch(rows, days[-1])


def profiled_columns(name: str, columns: Iterable[str]) -> list[str]:
    """Columns that checks look at: keys, references, domains, the event time and money."""
    spec = lookup(name)
    asked = {*(c for key in (spec.key, *spec.unique) for c in key), *spec.references, *spec.domains, spec.event_time}
    money = {f.name for f in spec.schema.fields if f.dataType.typeName() == "decimal"}
    return [c for c in columns if c in asked | money]


def load_profile(spark: SparkSession, name: str, root: str, ds: str) -> None:
    """Profile a day's silver rows; the day's profile is replaced."""
    path = layer_path(root, "quality", f"profiles/{name}")
    days = partition_values(spark, layer_path(root, "silver", name), "ingestion_date")
    if ds not in days:
        if ds in partition_values(spark, path, "ds"):
            drop_partition(spark, path, "ds", ds)
        return
    rows = batch(read_layer(spark, root, "silver", name), ds)
    made = profile(rows, name, F.lit(ds).cast("date"), profiled_columns(name, rows.columns))
    write(made, path, Mode.PARTITIONS, ["ds"], cluster=False)


def stored_profiles(spark: SparkSession, name: str, root: str) -> DataFrame | None:
    path = layer_path(root, "quality", f"profiles/{name}")
    if not partition_values(spark, path, "ds"):
        return None
    rows = spark.read.parquet(path)
    return rows.withColumn("ds", F.col("ds").cast("string"))


def check_day(spark: SparkSession, root: str, ds: str, names: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """Judge the day's silver tables and write the verdicts: rules from profiles, and rejected rows of the quarantine.

    Returns ``table_name, rule, ds, passed, failed`` for every table that the day has a profile of. No table is scanned
    again: profiles are small, and the quarantine's reasons are counted for the day alone.
    """
    found: DataFrame | None = None
    for name in names:
        parts = []
        profiles = stored_profiles(spark, name, root)
        if profiles is not None:
            parts.append(checks(profiles, lookup(name), ds))
        if ds in partition_values(spark, layer_path(root, "quarantine", name), "ingestion_date"):
            rejected = batch(read_layer(spark, root, "quarantine", name), ds)
            reasons = rejected.select(F.explode(F.split("reject_reason", ",")).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("failed"))
            parts.append(reasons.select(F.lit(name).alias("table_name"), "rule", F.lit(ds).alias("ds"), F.lit(0).cast("bigint").alias("passed"), "failed"))
        for part in parts:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "table_name string, rule string, ds string, passed bigint, failed bigint")
    path = layer_path(root, "quality", "checks")
    clear_checks(spark, path, ds)
    write(found.coalesce(1), path, Mode.PARTITIONS, ["ds"], cluster=False)
    written = spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string"))
    return written.filter(F.col("ds") == ds).select("table_name", "rule", "ds", "passed", "failed")


def clear_checks(spark: SparkSession, path: str, ds: str) -> None:
    if ds in partition_values(spark, path, "ds"):
        drop_partition(spark, path, "ds", ds)


def stamp(df: DataFrame, ds: str, run_id: str | None = None, version: str | None = None) -> DataFrame:
    columns = {"processed_at": F.current_timestamp(), "ds": F.lit(ds)}
    if run_id is not None:
        columns["_pipeline_run_id"] = F.lit(run_id)
    if version is not None:
        columns["_data_version"] = F.lit(version)
    return df.withColumns(columns)


def load_mart(
    name: str, tables: Mapping[str, DataFrame], root: str, ds: str, run_id: str | None = None, version: str | None = None
) -> None:
    spec = mart(name)
    write(
        stamp(spec.build(tables, ds), ds, run_id, version),
        layer_path(root, "gold", name),
        spec.mode,
        [spec.partition_by],
    )


def run_day(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    ds: str,
    marts: Iterable[str] = tuple(MARTS),
    run_id: str | None = None,
    version: str | None = None,
) -> None:
    """Load every given source table, judge the day, then build the marts from silver.

    All marts read the same silver tables in one session. The order-grain
    item sums that several marts use are written once to the checkpoint
    folder; nothing is pinned in executor memory. ``run_id`` and ``version`` go into silver rows
    and marts. Customers get versions, see :func:`load_versions`.
    """
    tune(spark)
    for name, source in sources.items():
        if load_raw(name, source, root, ds):
            load_silver(spark, name, root, ds, run_id=run_id, version=version)
        else:
            for layer in ("silver", "quarantine"):
                clear_day(spark, layer_path(root, layer, name), ds)
        load_profile(spark, name, root, ds)
        if name in VERSIONED:
            load_versions(spark, name, root, ds)
    check_day(spark, root, ds, list(sources))
    tables = {name: silver_view(spark, name, root, ds) for name in TABLES}
    marts = list(marts)
    if len(SHARE_ITEMS.intersection(marts)) > 1:
        tables["items_per_order"] = materialise(items_per_order(tables["order_items"]))
    for name in marts:
        load_mart(name, tables, root, ds, run_id, version)

"""Run a step of the daily pipeline, for use with spark-submit.

    python -m tallyhouse ingest  --table orders --ds 2024-01-15 --lake /lake --from /export/orders
    python -m tallyhouse ingest  --table orders --ds 2024-01-15 --lake /lake --jdbc jdbc:postgresql://db/shop
    python -m tallyhouse clean   --table orders --ds 2024-01-15 --lake /lake
    python -m tallyhouse mart    --mart daily_sales_mart --ds 2024-01-15 --lake /lake
    python -m tallyhouse day     --ds 2024-01-15 --lake /lake --from /export
    python -m tallyhouse check   --ds 2024-01-15 --lake /lake
    python -m tallyhouse export  --table daily_sales_mart --layer gold --lake /lake --to /out/sales
    python -m tallyhouse compact --table orders --layer silver --lake /lake
    python -m tallyhouse expire  --table orders --layer raw --ds 2024-01-15 --lake /lake
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.catalog import TABLES, table as lookup
from tallyhouse.operators.lifecycle import compact, expire_partitions
from tallyhouse.plans.marts import MARTS
from tallyhouse.plans.pipeline import check_day, load_mart, load_profile, load_raw, load_silver, run_day, silver_view
from tallyhouse.plans.upkeep import SALES, refresh_sales
from tallyhouse.session import start
from tallyhouse.sources import LAYERS, Split, export_parquet, layer_path, read_jdbc, read_layer

# Range queries that read a table over JDBC at a time.
JDBC_TASKS = 16


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallyhouse")
    steps = root.add_subparsers(dest="step", required=True)

    def step(name: str, *options: str) -> None:
        one = steps.add_parser(name)
        one.add_argument("--lake", required=True)
        if "ds" in options:
            one.add_argument("--ds", required=True)
        if "table" in options:
            one.add_argument("--table", required=True, choices=sorted(TABLES))
        if "stored" in options:
            one.add_argument("--table", required=True, choices=sorted({*TABLES, *MARTS}))
        if "layer" in options:
            one.add_argument("--layer", required=True, choices=LAYERS)
        if "mart" in options:
            one.add_argument("--mart", required=True, choices=sorted(MARTS))
        if "strict" in options:
            one.add_argument("--strict", action="store_true", help="refuse a source that does not fit the catalog")
        if "refresh" in options:
            one.add_argument("--refresh", action="store_true", help="rebuild only what the day touched, where the mart can")
        if "run" in options:
            one.add_argument("--run-id", help="goes into every row that the step writes")
            one.add_argument("--data-version", help="goes into every row that the step writes")
        if "source" in options:
            source = one.add_mutually_exclusive_group(required=True)
            source.add_argument("--from", dest="folder")
            source.add_argument("--jdbc")
            one.add_argument("--tasks", type=int, default=JDBC_TASKS, help="parallel range queries over a table's id")

    step("ingest", "ds", "table", "source", "strict")
    step("clean", "ds", "table", "run")
    step("mart", "ds", "mart", "run", "refresh")
    step("day", "ds", "source", "run")
    step("check", "ds")
    step("export", "stored", "layer")
    steps.choices["export"].add_argument("--to", required=True)
    step("compact", "table", "layer")
    step("expire", "ds", "stored", "layer")
    return root


def open_source(spark: SparkSession, args: argparse.Namespace, name: str, folder: str | None) -> DataFrame:
    """A table's parquet export, or the table itself over JDBC.

    Over JDBC a table with an id is read by several range queries. JDBC user and password come from the environment. The day filter that
    the pipeline applies to incremental tables reaches the database as a
    range on the event time.
    """
    if folder:
        return spark.read.parquet(folder)
    spec = lookup(name)
    columns = ", ".join(spec.schema.names)
    query = f"select {columns} from {name}"
    login = {"user": os.environ.get("JDBC_USER", ""), "password": os.environ.get("JDBC_PASSWORD", "")}
    split = None
    if spec.key == ("id",) and args.tasks > 1:
        # The ends of the id range, by one small query that the key's index answers.
        ends = read_jdbc(spark, args.jdbc, f"select min(id) as lowest, max(id) as highest from {name}", login).first()
        if ends and ends[0] is not None:
            split = Split("id", int(ends[0]), int(ends[1]) + 1, args.tasks)
    return read_jdbc(spark, args.jdbc, query, login, split)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = start(f"tallyhouse-{args.step}")
    if args.step == "ingest":
        load_raw(args.table, open_source(spark, args, args.table, args.folder), args.lake, args.ds, args.strict)
    elif args.step == "clean":
        load_silver(spark, args.table, args.lake, args.ds, run_id=args.run_id, version=args.data_version)
        load_profile(spark, args.table, args.lake, args.ds)
    elif args.step == "mart" and args.refresh and args.mart == SALES:
        refresh_sales(spark, args.lake, args.ds)
    elif args.step == "mart":
        load_mart(args.mart, available(spark, args.lake, args.ds), args.lake, args.ds, args.run_id, args.data_version)
    elif args.step == "day":
        names = sorted(TABLES)
        sources = {
            name: open_source(spark, args, name, args.folder and f"{args.folder}/{name}") for name in names
        }
        run_day(spark, sources, args.lake, args.ds, run_id=args.run_id, version=args.data_version)
    elif args.step == "check":
        failed = check_day(spark, args.lake, args.ds).filter("failed > 0").orderBy("table_name", "rule").collect()
        for row in failed:
            print(f"{row.table_name} {row.rule}: {row.failed} failed, {row.passed} passed")
    elif args.step == "export":
        export_parquet(read_layer(spark, args.lake, args.layer, args.table), args.to)
    elif args.step == "compact":
        spec = lookup(args.table)
        order = spec.partition_column or spec.event_time
        sort_by = [order] if args.layer == "silver" and order in spec.schema.names else []
        compact(spark, layer_path(args.lake, args.layer, args.table), "ingestion_date", sort_by=sort_by)
    elif args.step == "expire":
        column = day_column(args.layer, args.table)
        expire_partitions(spark, layer_path(args.lake, args.layer, args.table), column, args.layer, args.ds)


def day_column(layer: str, name: str) -> str:
    """The partition column that holds a table's days: that of loading, and in gold the mart's own."""
    if layer != "gold":
        return "ingestion_date"
    column = MARTS[name].partition_by if name in MARTS else None
    if column is None or not column.endswith("_date"):
        raise SystemExit(f"{name} has no days in gold: it is replaced as a whole")
    return column


def available(spark: SparkSession, lake: str, ds: str | None = None) -> dict[str, DataFrame]:
    """Rows of every silver table as of a day, or now."""
    return {name: silver_view(spark, name, lake, ds) for name in TABLES}


if __name__ == "__main__":
    main()

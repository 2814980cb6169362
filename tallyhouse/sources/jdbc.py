"""JDBC extraction, split over executors when a numeric column allows it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to read one query with several parallel range queries."""

    column: str
    lower: int
    upper: int
    partitions: int


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read ``query`` as a relation; without ``split`` one task reads it all."""
    return jdbc_reader(spark, url, query, properties, split, fetch_size).load()


def jdbc_reader(spark, url, query, properties=None, split=None, fetch_size=10_000):
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f"({query}) as source")
        .option("fetchsize", fetch_size)
        .options(**(properties or {}))
    )
    if split:
        reader = (
            reader.option("partitionColumn", split.column)
            .option("lowerBound", split.lower)
            .option("upperBound", split.upper)
            .option("numPartitions", split.partitions)
        )
    return reader

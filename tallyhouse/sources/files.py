"""CSV seeds and parquet exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.operators.sequence import dense_sequence


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema; a malformed row fails the load."""
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )


def reassign_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Drop the ids of a staged load and number the rows afresh in their order."""
    numbered = dense_sequence(df, key, "_new_id")
    columns = [numbered["_new_id"].alias(key) if name == key else numbered[name] for name in df.columns]
    return numbered.select(*columns)


def export_parquet(df: DataFrame, path: str) -> None:
    """Replace ``path`` with ``df``; timestamps are written in microseconds."""
    df.write.mode("overwrite").parquet(path)

"""Activity payloads and daily counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Payload fields, and which of them each activity carries.
PAYLOAD = "keyword string, results_count int, duration_seconds int, source string, quantity int"
PAYLOAD_FIELDS = {
    "search": ("keyword", "results_count"),
    "view": ("duration_seconds", "source"),
    "add_to_cart": ("quantity",),
}


def typed_payload(activity: DataFrame, schema: str = PAYLOAD) -> DataFrame:
    """Read the JSON metadata into one column per field; absent fields are NULL."""
    parsed = F.from_json("metadata", schema)
    return activity.withColumn("_payload", parsed).select(*activity.columns, "_payload.*")


def packed_payload(activity: DataFrame) -> DataFrame:
    """Write the fields of each activity into the JSON metadata; ``{}`` for the others."""
    packed = F.lit("{}")
    for kind, fields in PAYLOAD_FIELDS.items():
        present = [F.col(name) for name in fields if name in activity.columns]
        if present:
            packed = F.when(F.col("activity_type") == kind, F.to_json(F.struct(*present))).otherwise(packed)
    return activity.withColumn("metadata", packed)


def daily_activity(activity: DataFrame) -> DataFrame:
    """Events per day and activity type as a tumbling window, batch or streaming."""
    return (
        activity.groupBy(F.window("created_at", "1 day").alias("_window"), "activity_type")
        .agg(F.count(F.lit(1)).alias("activities"))
        .select(F.col("_window.start").alias("window_start"), "activity_type", "activities")
    )

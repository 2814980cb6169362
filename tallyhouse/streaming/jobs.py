"""Continuous twins of the activity counts and of cart expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.activity import daily_activity
from tallyhouse.operators.carts import IDLE_DAYS
from tallyhouse.sources.layers import is_file

# Events later than this behind the newest one are dropped.
LATENESS = "1 day"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """New parquet files of a table, a folder or a single file, as a stream.

    The watermark advances after every trigger. A cap on the files of a trigger is
    therefore right only where files arrive in order of time; without one,
    a trigger takes all that is there and nothing of it is late.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_file(spark, path):
        # A stream reads folders; one file is its folder with all other files left out.
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def timed(events: DataFrame, lateness: str) -> DataFrame:
    """Event time as an instant, with the watermark set on it."""
    instant = F.col("created_at").cast("timestamp")
    return events.withColumn("created_at", instant).withWatermark("created_at", lateness)


def deduplicated(events: DataFrame, key: str = "id", lateness: str = LATENESS) -> DataFrame:
    """Drop repeats of an event id that arrive within the allowed lateness."""
    return timed(events, lateness).dropDuplicatesWithinWatermark([key])


def stream_daily_activity(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Daily counts per activity type; a day is emitted once it can no longer change."""
    return daily_activity(timed(events, lateness))


def cart_sessions(touches: DataFrame, idle_days: int = IDLE_DAYS, lateness: str | None = LATENESS) -> DataFrame:
    """Activity spans per cart separated by more than ``idle_days`` of silence.

    ``touches`` has cart_id and created_at. A session ends ``idle_days``
    after its last touch; when the watermark passes that moment the stream
    emits it, which is the expiry of the cart. The same plan runs in batch.
    """
    if lateness:
        touches = timed(touches, lateness)
    return (
        touches.groupBy(F.session_window("created_at", f"{idle_days} days").alias("_span"), "cart_id")
        .agg(F.count(F.lit(1)).alias("touches"))
        .select(
            "cart_id",
            F.col("_span.start").alias("first_touch"),
            F.col("_span.end").alias("expires_at"),
            "touches",
        )
    )


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to parquet, processing what is available and then stopping."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

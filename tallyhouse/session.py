"""Session settings shared by every job.

Only runtime SQL settings are touched here, so the same function serves a
session made by a cluster launcher and one made for a local test.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Timestamps are UTC wall-clock values throughout. Shuffle width is left to
# AQE: it starts from the configured partition count and coalesces or splits
# from the observed sizes. ANSI stays at its default (on).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Sessions of one key merge inside each task before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Set when a session is created. Recording a Python call site for every
# column expression costs more than the rest of building a plan.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def start(app_name: str = "tallyhouse", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a tuned session; resources come from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (START_SETTINGS | conf).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private folder is made only where the setting is absent and the master is local, as in tests;
    on a cluster every machine would write to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and cut its lineage.

    Several marts read the result without recomputing it, and it outlives
    the executors that produced it.
    """
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)

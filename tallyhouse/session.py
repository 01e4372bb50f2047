"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is still split when a later step has to shuffle once more for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side is broadcast only below this size; beyond it the join shuffles.
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 << 20),
}


# Bytes of input for each shuffle partition.
PARTITION_BYTES = 128 << 20


def build_session(
    master: str | None = None, app: str = "tallyhouse", input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the engine's settings; `settings` (dots as `__`) override them.

    `input_bytes`: what the largest job reads; shuffles get a partition for each PARTITION_BYTES of it, 200 at least, which
    adaptive execution joins again where less moves.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    sized = {} if input_bytes is None else {"spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // PARTITION_BYTES)))}
    for key, value in {**SETTINGS, **sized, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

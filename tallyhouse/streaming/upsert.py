"""Keyed upsert of landing files as they arrive.

The load jobs are incremental batches; this runs the same merge from a file stream. A micro-batch rewrites the partitions
of the table that it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.lookup import dedupe_latest
from tallyhouse.operators.modify import merge_upsert
from tallyhouse.operators.presence import only_in_both
from tallyhouse.sources import store


def stream_landing(spark: SparkSession, folder: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def not_late(batch: DataFrame, target: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows of a batch that are not older than the target's row of the same key."""
    known = only_in_both(target.select(*keys, F.struct(*order_by).alias("_held")), batch, keys)
    late = F.col("_held").isNotNull() & (F.struct(*order_by) < F.col("_held"))
    return batch.join(known, list(keys), "left").filter(~late).select(*batch.columns)


def upsert_stream(
    stream: DataFrame, table_path: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str],
    insert_only: Sequence[str] = (), buckets: int = 16,
) -> StreamingQuery:
    """Merge each micro-batch into the table and stop when the files at hand are done.

    A row older, by `order_by`, than the one the table holds for its key is late and changes
    nothing, also across batches; of equal ones the later delivery stays. A batch replayed
    after a failure merges the same rows again, which leaves the table as it is, so the
    result is the same as with one delivery.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if store.read_if_exists(spark, table_path) is None:
            store.write_table(dedupe_latest(batch, keys, order_by), table_path, keys, buckets)
            return
        target = store.read_table(spark, table_path)
        fresh = not_late(batch, target, keys, order_by)
        merged = merge_upsert(only_in_both(target, fresh, keys), fresh, keys, insert_only, on_duplicate="latest", order_by=order_by)
        stage = f"{checkpoint}/changes/batch={batch_id}"
        store.truncate_load(merged, stage)
        store.apply_changes(spark, table_path, spark.read.schema(merged.schema).parquet(stage), keys, buckets)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

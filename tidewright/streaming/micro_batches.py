"""Optional: landing files picked up by Structured Streaming and merged batch by batch.

The loads proper are batch loads; this reuses the same upsert inside ``foreachBatch`` with
``availableNow``, so that the stream checkpoint remembers which files were taken. A batch whose number the store has logged for this
stream is fenced off: replayed, it changes nothing, not even a row that was changed since. One that died before its number was
logged is merged again, which as a keyed merge changes nothing twice either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidewright.operators.picks import latest_per_group
from tidewright.session import scratch_path
from tidewright.sources.store import Store


def merge_batches(
    stream: DataFrame,
    store: Store,
    layer: str,
    table: str,
    keys: Sequence[str],
    time_column: str,
    checkpoint: str | None = None,
    **rules,
) -> StreamingQuery:
    """Merge every micro-batch into a stored table; within a batch the newest row of a key wins."""

    place = checkpoint or scratch_path(store.spark, f"stream-{table}")

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(store, layer, table, keys, time_column, place, batch, batch_id, **rules)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )


STREAM_LOG, STREAM_DDL = "stream_batches", "table_name string, stream string, batch_id bigint"


def merge_batch(
    store: Store, layer: str, table: str, keys: Sequence[str], time_column: str, stream: str, batch: DataFrame, batch_id: int, **rules
) -> bool:
    """One batch of a stream, named by its checkpoint; false if it had been merged before."""
    if store.exists(layer, STREAM_LOG):
        log = store.read(layer, STREAM_LOG)
        if not log.filter((F.col("table_name") == table) & (F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return False
    newest = latest_per_group(batch, list(keys), [time_column])
    staged = store.stage(newest.select(*batch.columns), time_column, f"stream-{table}")
    if staged.rows and store.exists(layer, table):
        store.merge(layer, table, staged, keys, **rules)
    elif staged.rows:
        store.replace(layer, table, staged.frame)
    store.log(layer, STREAM_LOG, STREAM_DDL, store.spark.createDataFrame([(table, stream, batch_id)], STREAM_DDL).coalesce(1))
    return True


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)

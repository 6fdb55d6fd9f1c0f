"""Feed the keyed incremental sink from a file stream (micro-batches).

The warehouse has no streaming operators; this only drives the same
``upsert_table`` from Structured Streaming when raw files land continuously.
Each micro-batch is upserted on the unique key, which is idempotent: if a
batch is replayed after a failure (same epoch), the table ends the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratum.operators.latest import latest_per_key
from stratum.operators.upsert import upsert_table


def start_upsert_stream(spark: SparkSession, source_dir: str, schema: StructType, target_path: str,
                        key: str | list[str], *, checkpoint: str, order_by: list[str],
                        transform: Callable[[DataFrame], DataFrame] | None = None,
                        partition_by: list[str] | None = None, fmt: str = "parquet",
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start a query that upserts every new file batch into ``target_path``.

    ``transform`` is applied to the stream (stateless, e.g. the staging
    projection).  Of several rows of a key in one micro-batch the newest by
    ``order_by`` is taken.  ``available_now`` processes what is there and
    stops; otherwise ``processing_time`` sets the trigger interval.
    ``checkpoint`` names the query's folder in shared storage: a restart with
    the same folder goes on where the last run ended.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    if transform is not None:
        stream = transform(stream)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        newest = latest_per_key(batch, keys, order_by).select(*batch.columns)
        upsert_table(batch.sparkSession, newest, target_path, keys, partition_by=partition_by)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()

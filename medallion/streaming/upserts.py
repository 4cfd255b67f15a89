"""Merge landed files into a raw table, batch by batch.

The checkpoint of the stream takes the place of the watermark row.  A commit
records the number of its batch with the table, so a batch that is repeated
after a failure, when the checkpoint does not know of it yet, counts once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace as with_changes
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from medallion.contracts import Entity
from medallion.functions.times import instant
from medallion.operators.dedup import drop_duplicates
from medallion.operators.lake import Lake
from medallion.operators.merge import upsert

FILES_PER_BATCH = 1000


def read_landed(lake: Lake, path: str, schema: str, files_per_batch: int = FILES_PER_BATCH,
                file_format: str = "parquet") -> DataFrame:
    reader = lake.spark.readStream.schema(schema).format(file_format)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(path)


def stream_upserts(
    lake: Lake, stream: DataFrame, entity: Entity, checkpoint: str, run_ts: datetime,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge all files that have landed, then stop."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # Batches run in a session of their own; settings and table cache of
        # the outer one do not reach it.
        inner = with_changes(lake, spark=batch.sparkSession)
        rows = transform(batch) if transform else batch
        rows = drop_duplicates(rows, list(entity.keys), list(entity.arrival))
        # The query's id lives in its checkpoint: a stream that begins anew has another one.
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert(inner, rows, entity, instant(run_ts), unique=True, batch=(stream_id, batch_id) if stream_id else None)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(lake: Lake, query: StreamingQuery, entity: Entity) -> None:
    query.awaitTermination()
    lake.spark.catalog.refreshTable(lake.raw(entity))

"""Streaming sinks: lake files and the raw warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lumentide.sources.lake import deliver
from lumentide.sources.raw import write_batch

TRIGGER = "5 minutes"


def triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """A periodic trigger, or with None everything available now and then stop."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_lake(
    events: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Append to the lake, Parquet files by event date and batch. Exactly once.

    A micro-batch that is delivered again after a failure is known by the query's id, which
    lives in the checkpoint, and its number (see `sources.lake`). Unlike a file sink's folder
    the lake has no log of files: days can be expired while the stream goes on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        deliver(batch, path, query, batch_id)

    writer = (
        events.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return triggered(writer, trigger).start()


def write_warehouse(
    events: DataFrame, path: str, checkpoint: str, stream: str | None = None,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Append to the raw table, clustered within each date.

    A micro-batch may be delivered again after a failure. Its rows live in
    partitions named after the stream and the batch, which a repeated delivery
    overwrites, so the table holds every batch once. The stream's name is by default
    the query's id, which lives in the checkpoint: a query started over with an empty
    checkpoint counts its batches from zero but gets a new id and overwrites nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        name = stream or context.getLocalProperty("sql.streaming.queryId")
        write_batch(batch, path, f"{name}-{batch_id}")

    writer = (
        events.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return triggered(writer, trigger).start()


def run_dual_sink(
    events: DataFrame, lake_path: str, warehouse_path: str, checkpoints: str,
    stream: str | None = None, trigger: str | None = TRIGGER,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both sinks as independent queries; one failing leaves the other's progress alone."""
    lake = write_lake(events, lake_path, f"{checkpoints}/lake", trigger)
    warehouse = write_warehouse(
        events, warehouse_path, f"{checkpoints}/warehouse", stream, trigger)
    return lake, warehouse


def await_any(*queries: StreamingQuery, poll_seconds: int = 1) -> None:
    """Block until one of the queries ends, and fail if it failed."""
    while True:
        for query in queries:
            if query.awaitTermination(poll_seconds):
                return

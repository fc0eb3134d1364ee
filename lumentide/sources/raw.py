"""The raw event table: deliveries, loads, schema and compaction.

All writers use one layout, `event_date/batch`. A batch is what one micro-batch, lake load or
backfill delivered; writing it again overwrites it, so that the table holds every delivery
once. Beside the rows lie `_schema`, the table's columns (see `evolution`), and while batches are
being merged `_compactions`, what is to be done.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lumentide.schemas import LAKE_EVENTS, RAW_CLUSTERING, RAW_EVENTS
from lumentide.sources.evolution import (
    found_schema, merged, record_schema, recorded_schema,
)
from lumentide.sources.files import Storage
from lumentide.sources.landed import ALL_AGES
from lumentide.sources.layout import laid_out, partition_folder, read_folders

INTENTS, ASIDE = "_compactions", "_compacting-"
DELIVERING = "_delivering-"


def _without_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != "batch"])


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """The known columns of raw events, then those writers have added."""
    return merged(RAW_EVENTS, recorded_schema(spark, path) or T.StructType())


def write_batch(events: DataFrame, path: str, batch: str) -> None:
    """Write one delivery to the raw table; a repeated one replaces itself.

    Columns the table doesn't have yet are added to its schema, types widened. The files
    keep the writer's types; readers ask for the table's.

    The days are written to a hidden folder and, when all are complete, moved in one by one,
    several at a time. Spark's own dynamic overwrite does that one after the other.
    """
    spark, path = events.sparkSession, path.rstrip("/")
    record_schema(spark, path, _without_batch(events.schema))
    storage, aside = Storage(spark, path), f"{path}/{DELIVERING}{uuid.uuid4().hex}"
    try:
        laid_out(events.drop("batch"), "event_date", RAW_CLUSTERING).write.partitionBy(
            "event_date").parquet(aside)
        storage.move_folders(aside, path, "event_date", partition_folder("batch", batch))
    finally:
        storage.remove(aside)
        spark.catalog.refreshByPath(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw event table with all its columns; older files read as NULL or as wider types.

    Batches that a compaction has replaced but not removed yet, as after a failure, are
    left out, so every row is read once.
    """
    schema = table_schema(spark, path)
    rows = read_folders(spark, path, schema)
    hidden = [(day, name.partition("=")[2]) for intent in _intents(spark, path).values()
              for day, batches in intent.replaced(Storage(spark, path), path)
              for name in batches]
    if hidden:
        stale = F.concat_ws("/", F.date_format("event_date", "yyyy-MM-dd"), F.col("batch"))
        rows = rows.filter(~F.coalesce(stale.isin([f"{d}/{b}" for d, b in hidden]), F.lit(False)))
    return rows.select(*schema.fieldNames())


def as_raw_events(df: DataFrame, schema: T.StructType = RAW_EVENTS) -> DataFrame:
    """The columns of the raw table, cast to its types; those missing are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def _lake_schema(spark: SparkSession, path: str, merge_schema: bool) -> T.StructType:
    """Columns to read lake files with; the batch, where files lie in batches, is the last."""
    known = LAKE_EVENTS
    if merge_schema:
        storage = Storage(spark, path)
        days = [f"{path.rstrip('/')}/{e.name}" for e in storage.entries(path)
                if e.is_dir and e.name.startswith("event_date=")]
        known = merged(known, _without_batch(found_schema(spark, path, days)))
    parts = {"event_date": T.DateType(), "batch": T.StringType()}
    return T.StructType([f for f in known if f.name not in parts]
                        + [T.StructField(name, kind) for name, kind in parts.items()])


def start_lake_load(
    spark: SparkSession, lake_path: str, raw_path: str, checkpoint: str,
    merge_schema: bool = False,
) -> StreamingQuery:
    """Load the lake files that are new since the last load with this checkpoint.

    The lake is a file stream read to its present end; the checkpoint knows which files
    were loaded, so a load touches new files only, of whatever event date and age. A load
    that is repeated after a failure replaces what it wrote.

    With `merge_schema` columns that lake files have beside the known ones are found in
    their footers, added to the raw table and kept, types that changed widened. Without it
    the known columns are loaded and no footers are read for planning.
    """
    schema = _lake_schema(spark, lake_path, merge_schema)
    target = merged(RAW_EVENTS, _without_batch(schema)) if merge_schema else RAW_EVENTS
    files = spark.readStream.schema(schema).option("maxFileAge", ALL_AGES).parquet(lake_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(as_raw_events(batch, target), raw_path, f"lake-{query}-{batch_id}")

    return (
        files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
        .trigger(availableNow=True).start())


def load_lake_to_raw(
    spark: SparkSession, lake_path: str, raw_path: str, checkpoint: str,
    merge_schema: bool = False,
) -> DataFrame:
    """Load what is new in the lake into the raw table and return the table."""
    start_lake_load(spark, lake_path, raw_path, checkpoint, merge_schema).awaitTermination()
    return read_raw(spark, raw_path)


def append_backfill(events: DataFrame, raw_path: str, batch: str | None = None) -> DataFrame:
    """Append normalised history to the raw table and return the table.

    A backfill with a `batch` name replaces what an earlier one of that name wrote.
    """
    write_batch(as_raw_events(events), raw_path, f"backfill-{batch or uuid.uuid4().hex}")
    return read_raw(events.sparkSession, raw_path)


class _Intent:
    """What a compaction does once its merged rows are complete: a file that outlives it."""

    def __init__(self, merged_name: str, days: dict[str, list[str]]):
        self.merged, self.days = merged_name, days

    def place(self, path: str, day: str) -> str:
        return f"{path}/event_date={day}/batch={self.merged}"

    def aside(self, path: str) -> str:
        return f"{path}/{ASIDE}{self.merged}"

    def replaced(self, storage: Storage, path: str):
        """Days whose merged rows are in place, and the batches they stand for."""
        path = path.rstrip("/")
        for day, batches in self.days.items():
            if storage.exists(self.place(path, day)):
                yield day, batches

    def carry_out(self, storage: Storage, path: str) -> None:
        """Move the merged rows in and drop what they replace; all of it may be repeated."""
        for day, batches in self.days.items():
            written = f"{self.aside(path)}/event_date={day}/batch={self.merged}"
            if storage.exists(written):
                storage.move(written, self.place(path, day))
            for batch in batches:
                storage.remove(f"{path}/event_date={day}/{batch}")
        storage.remove(self.aside(path))
        storage.remove(f"{path}/{INTENTS}/{self.merged}")


def _intents(spark: SparkSession, path: str) -> dict[str, _Intent]:
    storage, folder = Storage(spark, path), f"{path.rstrip('/')}/{INTENTS}"
    return {e.name: _Intent(e.name, json.loads(storage.read(f"{folder}/{e.name}")))
            for e in storage.entries(folder) if not e.name.startswith(".")}


def finish_compactions(spark: SparkSession, path: str) -> list[str]:
    """Carry out what stopped compactions had decided, and drop what they hadn't.

    Returns the days of those carried out.
    """
    path = path.rstrip("/")
    storage, days = Storage(spark, path), set()
    for intent in _intents(spark, path).values():
        intent.carry_out(storage, path)
        days.update(intent.days)
    for entry in storage.entries(path):
        if entry.name.startswith(ASIDE):
            storage.remove(f"{path}/{entry.name}")
    for entry in storage.entries(f"{path}/{INTENTS}"):  # one that was being written
        storage.remove(f"{path}/{INTENTS}/{entry.name}")
    if days:
        spark.catalog.refreshByPath(path)
    return sorted(days)


def _writer(batch: str) -> str:
    """Who wrote a batch: backfills, loads, compactions, or the query a stream is."""
    name = batch.partition("=")[2]
    kind = name.partition("-")[0]
    return kind if kind in ("backfill", "lake", "compacted") else name.rpartition("-")[0]


def begin_compaction(
    spark: SparkSession, path: str, before: dt.date, keep: int = 1,
) -> list[str]:
    """Write the merged rows of the days to compact, and what they replace; name the days.

    Readers see no change until `finish_compactions`.
    """
    path = path.rstrip("/")
    storage = Storage(spark, path)
    days: dict[str, list[str]] = {}
    for day, name in storage.folders(path, "event_date"):
        if dt.date.fromisoformat(day) < before:
            batches = [batch for _, batch in storage.folders(f"{path}/{name}", "batch")]
            if len(batches) > keep:
                days[day] = batches
    if not days:
        return []
    schema = table_schema(spark, path)
    by_writer: dict[str, list[str]] = {}
    for day, batches in days.items():
        for batch in batches:
            by_writer.setdefault(_writer(batch), []).append(f"{path}/event_date={day}/{batch}")
    for folders in by_writer.values():  # a writer's files agree but where it was changed
        schema = merged(schema, _without_batch(found_schema(spark, path, sorted(folders))))
    schema = record_schema(spark, path, schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(
        *[f"{path}/event_date={day}" for day in days])
    intent = _Intent(f"compacted-{uuid.uuid4().hex}", days)
    (
        laid_out(rows.select(*schema.fieldNames()), "event_date", RAW_CLUSTERING)
        .withColumn("batch", F.lit(intent.merged))
        .write.partitionBy("event_date", "batch").parquet(intent.aside(path))
    )
    storage.write(f"{path}/{INTENTS}/{intent.merged}", json.dumps(days))
    return sorted(days)


def compact(spark: SparkSession, path: str, before: dt.date, keep: int = 1) -> list[str]:
    """Merge the batches of every day before `before` that has more than `keep` of them.

    Only for days no writer adds to any more: a delivery that was merged is not known by
    its batch. One compaction at a time.

    The merged rows, with all columns the days' files have, are written beside the table.
    When they are complete a small file says what they replace; only then rows move and
    batches go. Stopped before that file is there, nothing has happened; stopped after it,
    `read_raw` leaves replaced batches out and the next call finishes the work first.
    Names the days.
    """
    finished = finish_compactions(spark, path)
    if not begin_compaction(spark, path, before, keep):
        return finished
    return sorted({*finished, *finish_compactions(spark, path)})

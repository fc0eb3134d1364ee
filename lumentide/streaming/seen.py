"""Exact duplicates of a stream, however far apart: a table of all ids seen.

Unlike state with a time to live the table forgets nothing. Its parts are sorted by id
and carry Parquet Bloom filters, so looking up a micro-batch's ids skips the row groups that
hold none of them. Each micro-batch adds a small part; a full level of parts is merged into
one part of the next level, so an id is rewritten once for each level (the logarithm of all
micro-batches) and a look-up opens a bounded number of parts on every level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lumentide.operators.selection import dedupe_events
from lumentide.sources.files import Storage
from lumentide.sources.lake import deliver
from lumentide.streaming.sinks import TRIGGER, triggered

#: Parts of a level before they are merged, and rows of a merged part's row groups, about.
FAN_IN = 16
#: Ids of a micro-batch up to which they are looked up as a filter on the files. More of them
#: would be found in most row groups anyway; they are joined.
MOST_PUSHED = 20_000


class SeenIds:
    """The table of ids below a folder: `level=<n>/part=<name>`. One writer at a time.

    An id that stands in two parts, as after a merge that stopped before it had removed what
    it merged, is no harm: only whether an id is there matters.
    """

    def __init__(self, spark: SparkSession, path: str, kind: T.DataType, fan_in: int = FAN_IN):
        self.spark, self.path, self.fan_in = spark, path.rstrip("/"), fan_in
        self.schema = T.StructType([T.StructField("id", kind)])
        self.storage = Storage(spark, self.path)

    def _parts(self, level: int) -> list[str]:
        return [name for _, name in self.storage.folders(f"{self.path}/level={level}", "part")]

    def _levels(self) -> list[int]:
        return sorted(int(value) for value, _ in self.storage.folders(self.path, "level"))

    def ids(self, but: str | None = None) -> DataFrame:
        """All ids, those of one part left out."""
        folders = [f"{self.path}/level={level}/{name}" for level in self._levels()
                   for name in self._parts(level) if name != f"part={but}"]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, ids: DataFrame, level: int, name: str) -> None:
        rows = ids.sortWithinPartitions("id").write.mode("overwrite")
        (rows.option("parquet.bloom.filter.enabled#id", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true")
         .parquet(f"{self.path}/level={level}/part={name}"))

    def add(self, ids: DataFrame, name: str) -> None:
        """Add a part; the same name again replaces it. Then merge what is full."""
        self._write(ids, 0, name)
        for level in self._levels():
            parts = self._parts(level)
            if len(parts) < self.fan_in:
                continue
            folders = [f"{self.path}/level={level}/{part}" for part in parts]
            merged = self.spark.read.schema(self.schema).parquet(*folders)
            # Sorted over all files: a row group holds a narrow range of ids.
            self._write(merged.repartitionByRange("id"), level + 1, f"to-{parts[-1][5:]}")
            for folder in folders:
                self.storage.remove(folder)

    def known(self, batch: DataFrame, id_col: str, but: str | None = None) -> DataFrame:
        """Which ids of a batch are in the table, those of one part not counted."""
        ids = self.ids(but)
        some = [r[0] for r in batch.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
                .limit(MOST_PUSHED + 1).collect()]
        if len(some) <= MOST_PUSHED:
            return ids.filter(F.col("id").isin(some)).distinct()
        return ids.join(batch.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").distinct()


def start_exact_dedupe(
    events: DataFrame, path: str, checkpoint: str, seen_path: str, id_col: str = "event_id",
    first_by: Sequence[str] = ("ingested_at", "event_timestamp"), partition_by: str = "event_date",
    fan_in: int = FAN_IN, trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Deliver the first row of every id of a stream, exactly, over restarts and for ever.

    Of copies in one micro-batch the one delivered first stays (see `dedupe_events`). Rows
    without an id are nobody's copies. The rows go to a lake folder (see `sources.lake`).
    A micro-batch delivered again doesn't count its own ids as seen.
    """
    kind = events.schema[id_col].dataType

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        seen, name = SeenIds(spark, seen_path, kind, fan_in), f"{query}-{batch_id:012d}"
        done = f"{seen.path}/_batch-{name}"
        if not seen.storage.exists(f"{done}/_complete"):
            seen.storage.remove(done)
            known = seen.known(batch, id_col, but=name)
            # However large a landed file's row groups are, tasks get rows by measured bytes:
            # by whole rows, so that an id delivered very often is in many tasks.
            spread = batch.withColumn("_spread", F.xxhash64(*batch.columns)).hint(
                "rebalance", F.col("_spread")).drop("_spread")
            first = dedupe_events(spread, [id_col], first_by)
            first.join(known, F.col(id_col) == F.col("id"), "left_anti").write.parquet(done)
            seen.storage.write(f"{done}/_complete", "")
        fresh = spark.read.schema(batch.schema).parquet(done).select(*batch.columns)
        deliver(fresh, path, query, batch_id, partition_by)
        seen.add(fresh.select(F.col(id_col).alias("id")).filter("id is not null").coalesce(1)
                 if fresh.count() <= MOST_PUSHED else
                 fresh.select(F.col(id_col).alias("id")).filter("id is not null")
                 .repartitionByRange("id"), name)
        seen.storage.remove(done)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, trigger).start()

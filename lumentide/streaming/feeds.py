"""Feeds as continuous jobs: landed records to keyed messages, and the first of each hour."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lumentide.operators.envelope import to_envelope
from lumentide.operators.normalise import (
    normalise_arxiv, normalise_gdelt, normalise_wiki_changes, normalise_wiki_pageviews,
)
from lumentide.operators.selection import first_per_group
from lumentide.sources.files import Storage
from lumentide.sources.lake import deliver
from lumentide.sources.landed import (
    read_arxiv_entries, read_gdelt_exports, read_wiki_changes, read_wiki_pageviews,
)
from lumentide.streaming.sinks import TRIGGER, triggered

#: How each feed's landed files are read, and how its records become events.
FEEDS: dict[str, tuple[Callable[..., DataFrame], Callable[..., DataFrame]]] = {
    "wiki_changes": (read_wiki_changes, normalise_wiki_changes),
    "wiki_pageviews": (read_wiki_pageviews, normalise_wiki_pageviews),
    "gdelt": (read_gdelt_exports, normalise_gdelt),
    "arxiv": (read_arxiv_entries, normalise_arxiv),
}


def feed_messages(
    spark: SparkSession, feed: str, path: str, ingest_time: dt.datetime | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The messages of a feed, as a stream of the files that land in a folder.

    Narrow: a record becomes a message in the task that reads it. Limits on a group of
    records, such as the first of an hour, need `start_first_per_hour`.
    """
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    read, normalise = FEEDS[feed]
    records = read(spark, path, stream=True, max_files=max_files)
    return to_envelope(normalise(records, ingest_time=ingest_time))


def write_messages(
    messages: DataFrame, checkpoint: str, path: str | None = None, servers: str | None = None,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Send messages to a broker, or land them in a folder by topic and batch.

    The checkpoint holds what was sent, so a job that is started again goes on where it
    ended. Landed messages are there exactly once. The broker may get those of a micro-batch
    twice after a failure; `dedupe_stream` drops them again.
    """
    if (path is None) == (servers is None):
        raise ValueError("give a path or servers")
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    if servers is not None:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
        return triggered(writer, trigger).start()

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        deliver(batch, path, query, batch_id, partition_by="topic")

    return triggered(writer.foreachBatch(write), trigger).start()


OPEN, CLOSED = "_open", "closed"


def start_first_per_hour(
    records: DataFrame, path: str, checkpoint: str, n: int, order: Sequence[Column],
    time_col: str = "hour", late: dt.timedelta = dt.timedelta(hours=1),
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """The first `n` records of every full hour of a stream, exactly, with bounded state.

    An hour is open until a record `late` after its end has arrived; what comes for it in
    later micro-batches is left out. (A time that cannot be read belongs to no hour.) Open hours
    keep their first `n` records so far in a table below `path`, written anew by each
    micro-batch and known by its number: at most `n` records for each open hour, whatever
    has arrived. When an hour closes its records are delivered, once. All of it is relational
    work on a micro-batch: the first of its records and the kept ones, by `first_per_group`.
    A micro-batch that is delivered again starts from the table of the one before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        storage, query = Storage(spark, path), spark.sparkContext.getLocalProperty(
            "sql.streaming.queryId")
        states = f"{path.rstrip('/')}/{OPEN}-{query}"
        before = _state(storage, states, batch_id)
        hour = F.date_trunc("hour", time_col)
        fresh = batch.withColumn("_hour", hour).filter(F.col("_hour").isNotNull())
        if before and before["until"]:
            fresh = fresh.filter(F.col("_hour") >= F.lit(before["until"]).cast("timestamp"))
        kept = fresh if not before else spark.read.schema(fresh.schema).parquet(
            f"{states}/{before['batch']:012d}").unionByName(fresh)
        first = first_per_group(kept, ["_hour"], order, n)
        state = f"{states}/{batch_id:012d}"
        storage.remove(state)
        storage.remove(f"{states}/{batch_id:012d}.json")
        written = f"{state}-all"
        first.write.mode("overwrite").parquet(written)
        first = spark.read.schema(fresh.schema).parquet(written)
        # The newest hour is among the first records, too: an hour with records has some.
        newest = first.agg(F.max("_hour").cast("string")).first()[0]
        until = before["until"] if before else None
        if newest:
            closes = dt.datetime.fromisoformat(newest) - late
            closes = closes.replace(minute=0, second=0, microsecond=0).isoformat(sep=" ")
            until = max(until or closes, closes)
        is_open = F.lit(True) if until is None else F.col("_hour") >= F.lit(until).cast("timestamp")
        first.filter(is_open).write.parquet(state)
        day = F.to_date("_hour").alias("event_date")
        deliver(first.filter(~is_open).select("*", day).drop("_hour"),
                f"{path.rstrip('/')}/{CLOSED}", query, batch_id)
        storage.write(f"{states}/{batch_id:012d}.json", json.dumps({"until": until}))
        storage.remove(written)
        for entry in storage.entries(states):
            number = entry.name.partition(".")[0].partition("-")[0]
            if number.isdigit() and int(number) < batch_id - 1:
                storage.remove(f"{states}/{entry.name}")

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, trigger).start()


def _state(storage: Storage, states: str, before: int) -> dict | None:
    """What the last micro-batch before this one left."""
    done = [e.name for e in storage.entries(states)
            if e.name.endswith(".json") and not e.name.startswith(".")
            and int(e.name.removesuffix(".json")) < before]
    if not done:
        return None
    return {**json.loads(storage.read(f"{states}/{done[-1]}")),
            "batch": int(done[-1].removesuffix(".json"))}


def read_first_per_hour(spark: SparkSession, path: str, like: DataFrame, closed_only: bool = True) -> DataFrame:
    """The records of closed hours, and if wanted those of hours still open, so far."""
    storage, path = Storage(spark, path), path.rstrip("/")
    columns = like.columns
    closed = f"{path}/{CLOSED}"
    parts = ([spark.read.schema(like.schema).parquet(closed).select(*columns)]
             if storage.exists(closed) else [spark.createDataFrame([], like.schema)])
    if not closed_only:
        for entry in storage.entries(path):
            if entry.name.startswith(f"{OPEN}-"):
                last = _state(storage, f"{path}/{entry.name}", 1 << 62)
                if last:
                    parts.append(spark.read.schema(like.schema).parquet(
                        f"{path}/{entry.name}/{last['batch']:012d}").select(*columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

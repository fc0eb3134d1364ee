"""Parsing and enrichment of messages; the same code for batches and streams.

Narrow and entirely native: no shuffle, no Python worker.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lumentide.functions import adjusted_signal, consciousness_level, medium_dominance
from lumentide.schemas import ENVELOPE


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Flat columns of the JSON messages, all NULL where a message is malformed."""
    return messages.select(
        _event().alias("_event"), F.col("topic").alias("kafka_topic")
    ).select("_event.*", "kafka_topic")


def _event() -> Column:
    return F.from_json(F.col("value").cast("string"), ENVELOPE)


def with_event_time(events: DataFrame) -> DataFrame:
    """Event time as timestamp, NULL if unreadable, and its date."""
    return (
        events.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))
        .withColumn("event_date", F.to_date("event_timestamp"))
    )


def enrich(events: DataFrame) -> DataFrame:
    """Level, dominance and weighted signal; dominance looks at the unweighted signal."""
    return events.withColumns({
        "consciousness_level": consciousness_level(F.col("topic_category"), F.col("source")),
        "medium_dominance": medium_dominance(F.col("medium_type"), F.col("signal_strength")),
        "signal_strength": adjusted_signal(
            F.col("signal_strength"), F.col("source"), F.col("topic_category")),
    })


def parse_and_enrich(messages: DataFrame, ingest_time: dt.datetime | None = None) -> DataFrame:
    """Messages to enriched events as the sinks take them."""
    now = F.current_timestamp() if ingest_time is None else F.lit(ingest_time).cast("timestamp")
    return (
        enrich(with_event_time(messages.select(_event().alias("_event")).select("_event.*")))
        .withColumn("ingested_at", now)
    )


def dedupe_stream(events: DataFrame, within: str = "1 hour") -> DataFrame:
    """Drop repeated event ids that arrive within a span of time after the first.

    The watermark runs on the time of arrival, which no row can be late for: an event of
    any age passes when its id is new, and state is still bounded, since ids are
    forgotten a span after they arrived. Rows without an id are nobody's copies and pass.
    """
    arrived = (
        events.filter(F.col("event_id").isNotNull())
        .withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within))
    first = arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")
    return first.unionByName(events.filter(F.col("event_id").isNull()))

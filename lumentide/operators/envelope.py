"""Messages: writing, checking and reading envelopes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lumentide.functions import as_date, iso_utc
from lumentide.schemas import (
    ENVELOPE, ENVELOPE_OPTIONAL, ENVELOPE_REQUIRED, MEDIUM_TYPES, SOURCES, TOPIC_CATEGORIES,
)

TOPIC_OF_SOURCE = {
    "wiki_pageviews": "wiki_pageviews", "wiki_changes": "wiki_changes", "gdelt": "gdelt_events",
    "arxiv": "arxiv_papers",
}


def to_envelope(events: DataFrame) -> DataFrame:
    """Events as messages: `key` (what is attended to; for papers the category),
    `value` (JSON) and `topic`. A payload that is no JSON is sent empty."""
    key = F.when(
        F.col("source") == "arxiv", F.get_json_object("raw_payload", "$.category")
    ).otherwise(F.col("topic"))
    stream = F.coalesce(
        *[F.when(F.col("source") == s, t) for s, t in TOPIC_OF_SOURCE.items()], F.col("source"))
    body = F.struct(
        "event_id", "source",
        iso_utc(F.col("event_timestamp")).alias("event_timestamp"),
        "topic", "topic_category", "language", "country_code", "signal_strength", "medium_type",
        F.coalesce(F.try_parse_json("raw_payload"), F.parse_json(F.lit("{}"))).alias("raw_payload"),
        iso_utc(F.col("ingested_at")).alias("ingested_at"),
    )
    value = F.to_json(body, {"ignoreNullFields": "false"})
    return events.select(
        key.cast("binary").alias("key"), value.cast("binary").alias("value"),
        stream.alias("topic"))


def validate_envelope(messages: DataFrame) -> DataFrame:
    """Parsed messages with a `reject_reason`, NULL for a valid message.

    A message must be a JSON object with all required keys, no unknown ones, and
    known values of source, category and medium.
    """
    text = F.col("value").cast("string")
    parsed = (
        messages.withColumn("_keys", F.json_object_keys(text))
        .withColumn("_event", F.from_json(text, ENVELOPE))
    )
    required = F.array(*[F.lit(k) for k in ENVELOPE_REQUIRED])
    known = F.array(*[F.lit(k) for k in ENVELOPE_REQUIRED + ENVELOPE_OPTIONAL])

    def outside(field: str, allowed: tuple[str, ...]) -> Column:
        return ~F.coalesce(F.col("_event")[field].isin(*allowed), F.lit(False))

    reason = (
        F.when(F.col("_keys").isNull(), "malformed")
        .when(F.size(F.array_except(required, "_keys")) > 0, "missing_field")
        .when(F.size(F.array_except("_keys", known)) > 0, "unexpected_field")
        .when(outside("source", SOURCES), "unknown_source")
        .when(outside("topic_category", TOPIC_CATEGORIES), "unknown_topic_category")
        .when(outside("medium_type", MEDIUM_TYPES), "unknown_medium_type")
    )
    return (
        parsed.withColumn("reject_reason", reason)
        .select("_event.*", F.col("value"), F.col("reject_reason"))
    )


def filter_date_range(
    df: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None,
    days: int | None = None, as_of: dt.date | str | None = None, column: str = "event_date",
) -> DataFrame:
    """Rows from `start` to `end`, both included, or of the `days` up to `as_of`.

    On the partition column this prunes directories.
    """
    if days is not None:
        last = as_date(as_of)
        return df.filter(F.col(column).between(F.date_sub(last, days), last))
    if start is None or end is None:
        raise ValueError("give start and end, or days")
    return df.filter(F.col(column).between(as_date(start), as_date(end)))

"""Fact table: staged events of all layers with level and dominance."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lumentide.operators.staging import stage_all
from lumentide.schemas import WIKI_SOURCES

FACT_COLUMNS = (
    "event_id", "source", "event_timestamp", "event_date", "topic", "topic_category", "language",
    "country_code", "signal_strength", "medium_type", "attention_intensity", "ingested_at",
    "consciousness_level", "medium_dominance",
)


def label_events(staged: DataFrame) -> DataFrame:
    """Level and dominance of staged events by the warehouse rules."""
    source, signal = F.col("source"), F.col("signal_strength")
    level = (
        F.when(source == "arxiv", "integral")
        .when((source == "gdelt") & (F.col("topic_category") == "conflict"), "ethnocentric")
        .otherwise("worldcentric")
    )
    dominance = (
        F.when(source == "arxiv", "knowledge_led")
        .when(source.isin(*WIKI_SOURCES) & (signal >= 0.5), "memory_led")
        .when((source == "gdelt") & (signal >= 0.6), "media_led")
        .otherwise("ambient")
    )
    return staged.withColumns(
        {"consciousness_level": level, "medium_dominance": dominance}).select(*FACT_COLUMNS)


def fact_attention_events(*staged: DataFrame) -> DataFrame:
    """Union of staged tables, labelled."""
    return label_events(reduce(DataFrame.unionByName, staged))


def fact_from_raw(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """The same table straight from the raw events, reading them once."""
    return label_events(stage_all(raw, as_of))

"""Raw events to staged events: cleaning, validity, intensity labels.

The three layers differ in a few column rules only. `stage` applies one layer;
`stage_all` applies them together in a single pass over the raw table, which is
what the daily run uses instead of reading the table once per layer.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lumentide.functions import as_date, bands, strip_text, strip_ws
from lumentide.schemas import WIKI_SOURCES

STAGED_COLUMNS = (
    "event_id", "source", "event_timestamp", "event_date", "topic", "topic_category", "language",
    "country_code", "signal_strength", "medium_type", "ingested_at", "attention_intensity",
)


@dataclass(frozen=True)
class Layer:
    """What one layer does to the raw columns, texts being stripped of white space."""

    sources: tuple[str, ...]
    topic_longer_than: int
    language: Column
    country_code: Column
    medium_type: Column
    intensity: Column
    withdrawn: str | None = None

    def rows(self) -> Column:
        return F.col("source").isin(*self.sources)

    def accepts(self, topic: Column) -> Column:
        long_enough = F.length(topic) > self.topic_longer_than
        return long_enough if self.withdrawn is None else long_enough & ~topic.like(self.withdrawn)


def staging_start(as_of: dt.date) -> dt.date:
    """First day staging accepts: five years back, 28 February for a leap day."""
    try:
        return as_of.replace(year=as_of.year - 5)
    except ValueError:
        return as_of.replace(year=as_of.year - 5, day=28)


def _layers() -> tuple[Layer, Layer, Layer]:
    signal = F.col("signal_strength")
    country = F.upper("country_code")
    wiki = Layer(
        sources=WIKI_SOURCES,
        topic_longer_than=2,
        language=F.lower("language"),
        country_code=country,
        medium_type=F.lower(strip_ws(F.col("medium_type"))),
        intensity=F.when(
            F.col("source") == "wiki_changes",
            bands(signal, [(0.8, "major_edit"), (0.3, "moderate_edit")], "minor_edit"),
        ).otherwise(bands(signal, [(0.7, "viral"), (0.3, "trending")], "baseline")),
    )
    gdelt = Layer(
        sources=("gdelt",),
        topic_longer_than=1,
        language=F.lit("en"),
        country_code=country,
        medium_type=F.col("medium_type"),
        intensity=bands(
            signal, [(0.7, "high_intensity"), (0.4, "medium_intensity")], "low_intensity"),
    )
    arxiv = Layer(
        sources=("arxiv",),
        topic_longer_than=5,
        language=F.lit("en"),
        country_code=F.lit(None).cast("string"),
        medium_type=F.col("medium_type"),
        intensity=bands(
            signal, [(0.8, "high_collaboration"), (0.4, "standard")], "solo_or_small_team"),
        withdrawn="[WITHDRAWN]%",
    )
    return wiki, gdelt, arxiv


def _stage(raw: DataFrame, layers: tuple[Layer, ...], as_of: dt.date | str | None) -> DataFrame:
    day = as_date(as_of)

    def of_layer(column) -> Column:
        """The column of the layer a row belongs to."""
        *leading, last = layers
        if not leading:
            return column(last)
        first, *more = leading
        case = reduce(lambda c, x: c.when(x.rows(), column(x)), more,
                      F.when(first.rows(), column(first)))
        return case.otherwise(column(last))

    # Comparisons on bare columns come first: they reach the scan.
    candidates = raw.filter(
        F.col("source").isin(*[s for layer in layers for s in layer.sources])
        & F.col("event_date").between(F.add_months(day, -60), day)
        & F.col("signal_strength").between(0.0, 1.0)
    )
    return (
        candidates.withColumns({
            "topic": strip_text(F.col("topic")),
            "topic_category": strip_text(F.col("topic_category")),
            "language": strip_ws(F.col("language")),
            "country_code": strip_ws(F.col("country_code")),
        })
        .select(
            "event_id", "source",
            F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
            F.col("event_date").cast("date").alias("event_date"),
            "topic",
            F.lower("topic_category").alias("topic_category"),
            of_layer(lambda x: x.language).alias("language"),
            of_layer(lambda x: x.country_code).alias("country_code"),
            F.col("signal_strength").cast("double").alias("signal_strength"),
            of_layer(lambda x: x.medium_type).alias("medium_type"),
            F.col("ingested_at").cast("timestamp").alias("ingested_at"),
            of_layer(lambda x: x.intensity).alias("attention_intensity"),
        )
        .filter(of_layer(lambda x: x.accepts(F.col("topic"))))
        .select(*STAGED_COLUMNS)
    )


def stg_wikipedia(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Staged page views and edits."""
    return _stage(raw, _layers()[:1], as_of)


def stg_gdelt(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Staged news events."""
    return _stage(raw, _layers()[1:2], as_of)


def stg_arxiv(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Staged papers."""
    return _stage(raw, _layers()[2:], as_of)


def stage_all(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """All staged events in one pass; the union of the three layers."""
    return _stage(raw, _layers(), as_of)

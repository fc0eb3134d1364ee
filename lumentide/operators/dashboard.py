"""The dashboard mart and the data sets read from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F, types as T

from lumentide.functions import as_date
from lumentide.operators.aggregate import with_measures
from lumentide.schemas import KAIROS_LABEL

MART = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("topic_category", T.StringType()),
    T.StructField("medium_dominance", T.StringType()),
    T.StructField("consciousness_level", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("total_signal", T.DoubleType()),
    T.StructField("avg_signal", T.DoubleType()),
    T.StructField("shadow_index", T.DoubleType()),
    T.StructField("shadow_classification", T.StringType()),
    T.StructField("is_kairos_event", T.BooleanType()),
    T.StructField("kairos_label", T.StringType()),
    T.StructField("pct_of_daily_total", T.DoubleType()),
    T.StructField("tile_type", T.StringType()),
])


def _since(as_of: dt.date | str | None, days: int):
    return F.col("event_date") >= F.date_sub(as_date(as_of), days)


def dashboard_tile1(
    daily: DataFrame, as_of: dt.date | str | None = None, days: int = 30,
) -> DataFrame:
    """Attention by day, category, dominance and level, with its share of the day.

    Takes the fact table or its rollup.
    """
    tiles = (
        with_measures(daily.filter(_since(as_of, days)))
        .groupBy("event_date", "topic_category", "medium_dominance", "consciousness_level")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("total_signal_mass").alias("total_signal"),
            F.sum("signal_count").alias("signal_count"))
    )
    day_total = F.sum("event_count").over(Window.partitionBy("event_date"))
    return tiles.select(
        "event_date", "topic_category", "medium_dominance", "consciousness_level", "event_count",
        "total_signal",
        F.try_divide("total_signal", "signal_count").alias("avg_signal"),
        F.round(F.try_divide("event_count", day_total), 4).alias("pct_of_daily_total"),
        F.lit("categorical").alias("tile_type"),
    )


def dashboard_tile2(
    sync: DataFrame, shadow: DataFrame, level: DataFrame, agg: DataFrame,
    as_of: dt.date | str | None = None, days: int = 90,
) -> DataFrame:
    """Synchronicity, shadow index and level over time.

    `total_signal` holds the score and `avg_signal` its rolling mean. A NULL
    category joins nothing: no events, no shadow index.
    """
    pair = ["event_date", "topic_category"]
    recent = _since(as_of, days)
    volume = agg.filter(recent).groupBy(*pair).agg(F.sum("event_count").alias("event_count"))
    return (
        sync.filter(recent)
        .join(shadow.filter(recent).select(*pair, "shadow_index_raw", "shadow_classification"),
              pair, "left")
        .join(volume, pair, "left")
        .join(level.filter(recent).select("event_date", "dominant_level"), "event_date", "left")
        .select(
            "event_date", "topic_category",
            F.lit(None).cast("string").alias("medium_dominance"),
            F.col("dominant_level").alias("consciousness_level"),
            F.coalesce("event_count", F.lit(0)).alias("event_count"),
            F.col("synchronicity_score").alias("total_signal"),
            F.col("rolling_7d_synchronicity").alias("avg_signal"),
            F.col("shadow_index_raw").alias("shadow_index"),
            "shadow_classification",
            "is_kairos_event",
            F.when(F.col("is_kairos_event"), F.concat(F.lit(KAIROS_LABEL), "topic_category"))
            .alias("kairos_label"),
            F.lit(None).cast("double").alias("pct_of_daily_total"),
            F.lit("temporal").alias("tile_type"),
        )
    )


def _aligned(tile: DataFrame) -> DataFrame:
    """The mart's columns; those a tile lacks are NULL of the right type."""
    return tile.select(*[
        (F.col(f.name) if f.name in tile.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in MART.fields])


def mart_dashboard(tile1: DataFrame, tile2: DataFrame) -> DataFrame:
    """Both tiles, latest day first."""
    categorical = tile1.withColumn("is_kairos_event", F.lit(False))
    return _aligned(categorical).unionByName(_aligned(tile2)).orderBy(
        F.col("event_date").desc(), F.col("topic_category"))


def tile1_chart(mart: DataFrame) -> DataFrame:
    """Events by category and dominance, the bars of the first tile."""
    return (
        mart.filter(F.col("tile_type") == "categorical")
        .groupBy("topic_category", "medium_dominance")
        .agg(F.sum("event_count").alias("event_count"))
    )


def tile2_series(mart: DataFrame) -> DataFrame:
    """Score and shadow index by day, averaged over categories, the lines of the second."""
    return (
        mart.filter(F.col("tile_type") == "temporal")
        .groupBy("event_date")
        .agg(F.avg("total_signal").alias("total_signal"),
             F.avg("shadow_index").alias("shadow_index"))
    )


def recent_kairos_events(
    sync: DataFrame, as_of: dt.date | str | None = None, days: int = 7,
) -> DataFrame:
    """Flagged days and categories of the last days."""
    return sync.filter(_since(as_of, days) & F.col("is_kairos_event"))

"""Daily aggregates of the fact table.

Everything above the fact table depends on it through counts, sums and maxima per
day, category, source, dominance and level. `daily_rollup` computes just those, in
one pass with map-side combining, and is tiny: its size follows the number of days.
All aggregating operators accept either the fact table or its rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lumentide.schemas import HIGH_INTENSITY

ROLLUP_KEYS = (
    "event_date", "topic_category", "source", "medium_dominance", "consciousness_level",
)
MEASURES = {
    "event_count": F.sum, "signal_count": F.sum, "total_signal_mass": F.sum,
    "peak_signal_strength": F.max, "high_intensity_count": F.sum,
}


def with_measures(daily: DataFrame) -> DataFrame:
    """Fact rows as one-event measures; a rollup is passed on as it is."""
    if "event_count" in daily.columns:
        return daily
    signal = F.col("signal_strength")
    high = F.coalesce(F.col("attention_intensity").isin(*HIGH_INTENSITY), F.lit(False))
    return daily.withColumns({
        "event_count": F.lit(1).cast("bigint"),
        "signal_count": signal.isNotNull().cast("bigint"),
        "total_signal_mass": signal,
        "peak_signal_strength": signal,
        "high_intensity_count": high.cast("bigint"),
    })


def summarise(daily: DataFrame, *keys: str) -> DataFrame:
    """Measures per key."""
    return with_measures(daily).groupBy(*keys).agg(
        *[combine(name).alias(name) for name, combine in MEASURES.items()])


def daily_rollup(fact: DataFrame) -> DataFrame:
    """Measures per day, category, source, dominance and level."""
    return summarise(fact, *ROLLUP_KEYS)


def agg_daily_attention(daily: DataFrame) -> DataFrame:
    """Daily attention with rolling means, growth and density.

    The rolling windows run over rows, not days: a day has one row per dominance
    group. Rows of one day are ordered by dominance.
    """
    base = (
        summarise(daily, "event_date", "topic_category", "source", "medium_dominance")
        .withColumn("avg_signal_strength", F.try_divide("total_signal_mass", "signal_count"))
    )
    history = Window.partitionBy("topic_category", "source").orderBy(
        "event_date", "medium_dominance")
    week = history.rowsBetween(-6, 0)
    rolled = base.withColumns({
        "rolling_7d_event_count": F.avg("event_count").over(week),
        "rolling_7d_signal_strength": F.avg("avg_signal_strength").over(week),
        "event_count_7d_ago": F.lag("event_count", 7).over(history),
    })
    return rolled.select(
        "event_date", "topic_category", "source", "medium_dominance", "event_count",
        "avg_signal_strength", "peak_signal_strength", "total_signal_mass",
        "high_intensity_count", "rolling_7d_event_count", "rolling_7d_signal_strength",
        "event_count_7d_ago",
        F.try_divide(
            F.col("event_count") - F.col("event_count_7d_ago"), "event_count_7d_ago",
        ).alias("wow_growth_rate"),
        F.round(
            F.col("total_signal_mass") * F.log(1 + F.col("event_count")), 4,
        ).alias("noospheric_density"),
    )


def daily_noospheric_density(agg: DataFrame) -> DataFrame:
    """Density of a whole day, all layers together."""
    return agg.groupBy("event_date").agg(F.sum("noospheric_density").alias("noospheric_density"))

"""Metrics across sources: synchronicity, shadow index, level distribution."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumentide.functions import null_greatest
from lumentide.operators.aggregate import with_measures
from lumentide.schemas import ACTIVE_SIGNAL, KAIROS_SCORE, LEVELS

SIGNAL_OF_SOURCE = {
    "wiki_pageviews": "wiki_pv_signal", "wiki_changes": "wiki_ch_signal",
    "gdelt": "gdelt_signal", "arxiv": "arxiv_signal",
}


def source_signals(agg: DataFrame) -> DataFrame:
    """Signals of the four sources side by side, per day and category.

    A source's signal is its strongest dominance group. Both the synchronicity
    score and the shadow index build on this.
    """
    return agg.groupBy("event_date", "topic_category").agg(
        *[F.max(F.when(F.col("source") == source, F.col("avg_signal_strength"))).alias(name)
          for source, name in SIGNAL_OF_SOURCE.items()],
        F.sum("noospheric_density").alias("total_noospheric_density"),
    )


def _signals_of(agg_or_signals: DataFrame) -> DataFrame:
    if "wiki_pv_signal" in agg_or_signals.columns:
        return agg_or_signals
    return source_signals(agg_or_signals)


def _trailing(rows: int):
    return Window.partitionBy("topic_category").orderBy("event_date").rowsBetween(1 - rows, 0)


def synchronicity_score(agg: DataFrame) -> DataFrame:
    """Convergence of the four sources on a category: strong, even and shared by all.

    Takes the daily aggregate or the result of `source_signals`.
    """
    signals = [F.coalesce(name, F.lit(0.0)) for name in SIGNAL_OF_SOURCE.values()]
    mean = F.col("mean_signal")
    spread = [(s - mean) * (s - mean) for s in signals]
    evenness = 1.0 - F.least(F.col("signal_variance") * 2.0, F.lit(1.0))
    scored = (
        _signals_of(agg)
        .withColumns({
            "active_source_count": reduce(
                add, [(s > ACTIVE_SIGNAL).cast("bigint") for s in signals]),
            "mean_signal": reduce(add, signals) / 4.0,
        })
        .withColumn("signal_variance", reduce(add, spread) / 4.0)
        .withColumn("synchronicity_score", F.round(F.least(
            mean * F.col("active_source_count") / 4.0 * evenness, F.lit(1.0)), 4))
    )
    score = F.col("synchronicity_score")
    return scored.select(
        "event_date", "topic_category", *SIGNAL_OF_SOURCE.values(), "active_source_count",
        "mean_signal", "signal_variance", "total_noospheric_density", "synchronicity_score",
        (score >= KAIROS_SCORE).alias("is_kairos_event"),
        F.avg(score).over(_trailing(7)).alias("rolling_7d_synchronicity"),
    )


def synchronicity_band(score: Column) -> Column:
    """Name of a score's range; a range includes its lower end."""
    return (
        F.when(score < 0.2, "Fragmented").when(score < 0.5, "Coherent")
        .when(score < KAIROS_SCORE, "Convergent").when(score.isNotNull(), "Synchronic")
    )


def shadow_index(agg: DataFrame) -> DataFrame:
    """Private interest against public coverage, per day and category.

    Takes the daily aggregate or the result of `source_signals`. The normalised
    index needs both a private and a public signal; the others count a missing
    signal as zero.
    """
    private, public = F.col("private_signal"), F.col("public_signal")

    def gap(left: Column, right: Column) -> Column:
        return F.round(F.coalesce(left, F.lit(0.0)) - F.coalesce(right, F.lit(0.0)), 4)

    indexed = (
        _signals_of(agg)
        .select(
            "event_date", "topic_category",
            F.col("wiki_pv_signal").alias("private_signal"),
            F.col("gdelt_signal").alias("public_signal"),
            F.col("arxiv_signal").alias("expert_signal"),
            F.col("wiki_ch_signal").alias("memory_signal"))
        .withColumns({
            "shadow_index_raw": gap(private, public),
            "expert_public_gap": gap(F.col("expert_signal"), public),
        })
    )
    raw = F.col("shadow_index_raw")
    scale = null_greatest(F.abs(private), F.abs(public), F.lit(0.001))
    return indexed.withColumns({
        "shadow_index_normalised": F.round(F.try_divide(raw, scale), 4),
        "shadow_classification": F.when(raw > 0.3, "strongly_repressed")
        .when(raw > 0.1, "mildly_repressed")
        .when(raw > -0.1, "aligned")
        .when(raw > -0.3, "mildly_manufactured")
        .otherwise("strongly_manufactured"),
        "rolling_30d_shadow_index": F.avg(raw).over(_trailing(30)),
    })


def consciousness_level_daily(daily: DataFrame) -> DataFrame:
    """Share of every level in a day's events and signal, and the composite level.

    Takes the fact table or its rollup and needs a single grouping by day. The
    rolling mean has no natural partition; its one task sees one row per day.
    """
    def of_level(level: str, measure: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("consciousness_level") == level, F.col(measure))), F.lit(0))

    counts = {level: F.col(f"{level}_count") for level in LEVELS}
    days = (
        with_measures(daily).filter(F.col("consciousness_level").isNotNull())
        .groupBy("event_date").agg(
            F.sum("event_count").alias("total_events"),
            F.sum("total_signal_mass").alias("total_signal_mass"),
            *[of_level(level, "event_count").alias(f"{level}_count") for level in LEVELS],
            *[of_level(level, "total_signal_mass").alias(f"{level}_mass") for level in LEVELS])
        .withColumns({
            "composite": F.try_divide(
                reduce(add, [n * F.lit(float(rank)) for rank, n in enumerate(counts.values(), 1)]),
                "total_events"),
            "most": F.greatest(*counts.values()),
        })
    )
    return days.select(
        "event_date", "total_events", "total_signal_mass",
        *[F.round(F.try_divide(counts[level], "total_events"), 4).alias(f"pct_{level}")
          for level in LEVELS],
        *[F.round(F.try_divide(f"{level}_mass", "total_signal_mass"), 4)
          .alias(f"signal_pct_{level}") for level in LEVELS],
        F.round("composite", 4).alias("composite_consciousness_score"),
        F.coalesce(*[F.when(n == F.col("most"), level) for level, n in counts.items()])
        .alias("dominant_level"),
        F.avg("composite").over(Window.orderBy("event_date").rowsBetween(-6, 0))
        .alias("rolling_7d_consciousness_score"),
    )

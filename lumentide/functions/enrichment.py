"""Stream enrichment rules. The fact table has rules of its own, see operators.fact."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lumentide.functions.common import clamp_signal, is_blank, map_lookup
from lumentide.schemas import (
    CATEGORY_LEVEL, LEVELS, SALIENCE_BOOST, SALIENT_CATEGORIES, SOURCE_LEVEL_SHIFT, SOURCE_WEIGHT,
)


def consciousness_level(topic_category: Column, source: Column) -> Column:
    """Level of a category, moved up or down by the source within the four levels."""
    base = map_lookup(
        topic_category, {c: LEVELS.index(level) for c, level in CATEGORY_LEVEL.items()}, 0)
    shift = map_lookup(source, {s: n for s, n in SOURCE_LEVEL_SHIFT.items() if n}, 0)
    position = F.greatest(F.lit(0), F.least(F.lit(len(LEVELS) - 1), base + shift))
    level = F.element_at(F.array(*[F.lit(name) for name in LEVELS]), position + 1)
    return F.when(is_blank(topic_category), LEVELS[0]).otherwise(level)


def medium_dominance(medium_type: Column, signal: Column) -> Column:
    """Which kind of medium leads, judged on the unweighted signal."""
    def above(cut: float) -> Column:
        # NaN sorts above every number in Spark but exceeds no cut.
        return F.coalesce((signal > cut) & ~F.isnan(signal), F.lit(False))

    return (
        F.when(is_blank(medium_type), "unknown")
        .when((medium_type == "institutional_media") & above(0.6), "media_led")
        .when((medium_type == "formal_knowledge") & above(0.4), "knowledge_led")
        .when(medium_type == "collective_memory", "memory_led")
        .otherwise("ambient")
    )


def adjusted_signal(raw: Column, source: Column, topic_category: Column) -> Column:
    """Signal weighted by source and salience, at most 1, as 32-bit float."""
    plain = map_lookup(source, SOURCE_WEIGHT, 1.0)
    boosted = map_lookup(
        source, {s: w * SALIENCE_BOOST for s, w in SOURCE_WEIGHT.items()}, SALIENCE_BOOST)
    weight = F.when(topic_category.isin(*SALIENT_CATEGORIES), boosted).otherwise(plain)
    strength = F.coalesce(raw.cast("double"), F.lit(0.0))
    return clamp_signal(strength * weight).cast("float")

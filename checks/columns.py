"""How result columns are presented, the same way by Spark and by DuckDB.

A layout lists `name:kind` pairs. Kinds: s text, d date as text, t timestamp as
text, i bigint, n bigint that may be NULL (as double), x double that both engines
compute bit for bit alike, r double whose last bits depend on the order of
additions (rounded to 9 digits), b boolean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ENVELOPE = (
    "event_id:s source:s event_timestamp:t event_date:d topic:s topic_category:s language:s "
    "country_code:s signal_strength:x medium_type:s"
)
NORMALISED = ENVELOPE + " ingested_at:t"
STAGED = NORMALISED + " attention_intensity:s"
FACT = STAGED + " consciousness_level:s medium_dominance:s"
ENRICHED = ENVELOPE + " consciousness_level:s medium_dominance:s"
AGG = (
    "event_date:d topic_category:s source:s medium_dominance:s event_count:i "
    "avg_signal_strength:x peak_signal_strength:x total_signal_mass:x high_intensity_count:i "
    "rolling_7d_event_count:x rolling_7d_signal_strength:r event_count_7d_ago:n "
    "wow_growth_rate:x noospheric_density:r"
)
ROLLUP = (
    "event_date:d topic_category:s source:s medium_dominance:s consciousness_level:s "
    "event_count:i signal_count:i total_signal_mass:x peak_signal_strength:x "
    "high_intensity_count:i"
)
SIGNALS = (
    "event_date:d topic_category:s wiki_pv_signal:x wiki_ch_signal:x gdelt_signal:x "
    "arxiv_signal:x"
)
SYNC = SIGNALS + (
    " active_source_count:i mean_signal:r signal_variance:r total_noospheric_density:r "
    "synchronicity_score:r is_kairos_event:b rolling_7d_synchronicity:r"
)
SHADOW = (
    "event_date:d topic_category:s private_signal:x public_signal:x expert_signal:x "
    "memory_signal:x shadow_index_raw:r expert_public_gap:r shadow_index_normalised:r "
    "shadow_classification:s rolling_30d_shadow_index:r"
)
LEVEL = (
    "event_date:d total_events:i total_signal_mass:x "
    "pct_egocentric:r pct_ethnocentric:r pct_worldcentric:r pct_integral:r "
    "signal_pct_egocentric:r signal_pct_ethnocentric:r signal_pct_worldcentric:r "
    "signal_pct_integral:r composite_consciousness_score:r dominant_level:s "
    "rolling_7d_consciousness_score:r"
)
TILE1 = (
    "event_date:d topic_category:s medium_dominance:s consciousness_level:s event_count:i "
    "total_signal:x avg_signal:x pct_of_daily_total:r tile_type:s"
)
MART = (
    "event_date:d topic_category:s medium_dominance:s consciousness_level:s event_count:i "
    "total_signal:r avg_signal:r shadow_index:r shadow_classification:s is_kairos_event:b "
    "kairos_label:s pct_of_daily_total:r tile_type:s"
)


def _pairs(layout: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) for item in layout.split()]


def present(df: DataFrame, layout: str) -> DataFrame:
    """The layout's columns of a Spark result."""
    def shown(name: str, kind: str) -> Column:
        c = F.col(name)
        return {
            "s": c.cast("string"),
            "d": c.cast("string"),
            "t": F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind == "t" else c,
            "i": c.cast("bigint"),
            "n": c.cast("double"),
            "x": c.cast("double"),
            "r": F.round(c.cast("double"), 9) if kind == "r" else c,
            "b": c,
        }[kind].alias(name)

    return df.select(*[shown(*pair) for pair in _pairs(layout)])


def select_list(layout: str) -> str:
    """The layout as a DuckDB select list. Adding 0.0 turns -0.0 into 0.0."""
    templates = {
        "s": "CAST({0} AS VARCHAR)",
        "d": "CAST(CAST({0} AS DATE) AS VARCHAR)",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
        "i": "CAST({0} AS BIGINT)",
        "n": "CAST({0} AS DOUBLE)",
        "x": "CAST({0} AS DOUBLE)",
        "r": "round(CAST({0} AS DOUBLE), 9) + 0.0",
        "b": "{0}",
    }
    return ", ".join(f"{templates[kind].format(name)} AS {name}" for name, kind in _pairs(layout))

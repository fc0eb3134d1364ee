"""Column functions: native expressions only, no Python workers."""

from lumentide.functions.classify import arxiv_to_category, cameo_to_category, classify_topic
from lumentide.functions.common import (
    as_date, bands, clamp_signal, make_event_id, map_lookup, null_greatest, strip_text,
    strip_ws,
)
from lumentide.functions.enrichment import adjusted_signal, consciousness_level, medium_dominance
from lumentide.functions.times import iso_utc, parse_compact, parse_iso, parse_rfc822

__all__ = [
    "adjusted_signal", "arxiv_to_category", "as_date", "bands", "cameo_to_category",
    "clamp_signal", "classify_topic", "consciousness_level", "iso_utc", "make_event_id",
    "map_lookup", "medium_dominance", "null_greatest", "parse_compact", "parse_iso",
    "parse_rfc822", "strip_text", "strip_ws",
]

"""Event schemas, enumerations and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

SOURCES = ("wiki_pageviews", "wiki_changes", "gdelt", "arxiv")
WIKI_SOURCES = ("wiki_pageviews", "wiki_changes")
MEDIUM_TYPES = ("formal_knowledge", "collective_memory", "institutional_media")
TOPIC_CATEGORIES = (
    "science", "conflict", "health", "environment", "culture", "economics", "uncategorised",
)
STREAM_TOPICS = ("wiki_pageviews", "wiki_changes", "gdelt_events", "arxiv_papers")

# Lower-cased title keywords, categories in matching order.
TOPIC_KEYWORDS = {
    "science": ("science", "physics", "ai", "technology", "research", "biology"),
    "conflict": ("war", "conflict", "politics", "election", "protest", "military"),
    "health": ("health", "disease", "medicine", "pandemic", "mental"),
    "environment": ("climate", "environment", "ecology", "pollution", "energy"),
    "culture": ("culture", "art", "religion", "history", "philosophy"),
    "economics": ("economy", "finance", "market", "trade", "inflation"),
}

# Two-digit CAMEO root code -> category.
CAMEO_CATEGORY = {
    "01": "culture", "02": "culture", "03": "economics", "05": "science", "07": "economics",
    "08": "economics", "10": "health", "14": "conflict", "18": "conflict", "19": "conflict",
    "20": "conflict",
}

# Archive name of an arXiv category (text before the first dot) -> category.
ARXIV_CATEGORY = {
    "astro": "science", "cond": "science", "cs": "science", "econ": "economics",
    "eess": "science", "math": "science", "physics": "science", "q-bio": "health",
    "q-fin": "economics", "stat": "science",
}

# GDELT 2.0 export: zero-based column positions and the least column count.
GDELT_COLUMNS = {
    "id": 0, "date": 1, "actor1": 6, "actor2": 16, "code": 26, "articles": 33, "tone": 34,
    "country": 37,
}
GDELT_MIN_COLUMNS = 58

LEVELS = ("egocentric", "ethnocentric", "worldcentric", "integral")
CATEGORY_LEVEL = {
    "conflict": "ethnocentric", "culture": "ethnocentric", "economics": "worldcentric",
    "environment": "worldcentric", "health": "worldcentric", "science": "integral",
    "uncategorised": "egocentric",
}
SOURCE_LEVEL_SHIFT = {"arxiv": 1, "gdelt": -1, "wiki_changes": 0, "wiki_pageviews": 0}

SOURCE_WEIGHT = {"arxiv": 1.10, "gdelt": 0.75, "wiki_changes": 1.00, "wiki_pageviews": 0.85}
SALIENT_CATEGORIES = ("environment", "health")
SALIENCE_BOOST = 1.15

HIGH_INTENSITY = ("viral", "major_edit", "high_intensity", "high_collaboration")
ACTIVE_SIGNAL = 0.2
KAIROS_SCORE = 0.8
KAIROS_LABEL = "⚡ Kairos: "
RETENTION_DAYS = 1825

# --- schemas ----------------------------------------------------------------

# What the stream parses out of a message; the payload is left behind.
ENVELOPE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("topic_category", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("signal_strength", T.FloatType()),
    T.StructField("medium_type", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])

# Keys a message must carry, and keys it may carry besides.
ENVELOPE_REQUIRED = (
    "event_id", "source", "event_timestamp", "topic", "topic_category", "language",
    "country_code", "signal_strength", "medium_type",
)
ENVELOPE_OPTIONAL = ("raw_payload", "ingested_at")

# The raw event table, partitioned by event_date, clustered by the two below.
RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("topic", T.StringType()),
    T.StructField("topic_category", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("signal_strength", T.DoubleType()),
    T.StructField("medium_type", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
RAW_CLUSTERING = ("source", "topic_category")

# Files the stream writes to the lake.
LAKE_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("topic_category", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("signal_strength", T.FloatType()),
    T.StructField("medium_type", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("consciousness_level", T.StringType()),
    T.StructField("medium_dominance", T.StringType()),
    T.StructField("event_date", T.DateType()),
])

# Landed raw records.
WIKI_CHANGE = T.StructType([
    T.StructField("namespace", T.IntegerType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("title", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("revision", T.StructType([T.StructField("new", T.LongType())])),
    T.StructField("length", T.StructType([
        T.StructField("new", T.LongType()), T.StructField("old", T.LongType()),
    ])),
])
PAGEVIEW = T.StructType([
    T.StructField("hour", T.TimestampType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("article", T.StringType()),
    T.StructField("views", T.LongType()),
])
ARXIV_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("summary", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("feed_date", T.DateType()),
    T.StructField("position", T.IntegerType()),
])

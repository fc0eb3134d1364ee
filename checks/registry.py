"""Every operator as a query over the given tables, paired with its DuckDB text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import columns, inputs, oracle
from checks.inputs import AS_OF, INGEST_TIME, QUALITY_DAY
from lumentide.functions import (
    adjusted_signal, arxiv_to_category, cameo_to_category, classify_topic, consciousness_level,
    make_event_id, medium_dominance,
)
from lumentide.operators import aggregate, dashboard, envelope, fact, metrics, normalise, quality
from lumentide.operators.selection import dedupe_events
from lumentide.operators.staging import stg_arxiv, stg_gdelt, stg_wikipedia
from lumentide.plans.daily import (
    read_daily, rebuild_tables, refresh_changed, refresh_tables, run_daily,
)
from lumentide.session import configure, pin, shared_dir
from lumentide.sources import landed, raw, tables
from lumentide.sources.files import Storage
from lumentide.sources.versions import NotPublished
from lumentide.streaming import enrich, feeds, seen, sinks, source

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, layout: str, relation: str, where: str = "", sql: str | None = None):
    """Register a query under `name`, presented by `layout`, and its SQL on a view."""
    def decorate(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return columns.present(build(configure(spark), sf_dir), layout)

        QUERIES[name] = run
        ORACLES[name] = sql or oracle.shown(layout, relation, where)
        return build
    return decorate


# --- inputs shared by several queries ---------------------------------------

def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.fact_from_raw(inputs.raw_events(spark, sf_dir), AS_OF)


def _agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.agg_daily_attention(_fact(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    rollup = pin(aggregate.daily_rollup(_fact(spark, sf_dir)))
    agg = aggregate.agg_daily_attention(rollup)
    return dashboard.mart_dashboard(
        dashboard.dashboard_tile1(rollup, as_of),
        dashboard.dashboard_tile2(
            metrics.synchronicity_score(agg), metrics.shadow_index(agg),
            metrics.consciousness_level_daily(rollup), agg, as_of))


# --- normalisers ------------------------------------------------------------

PAYLOAD = columns.NORMALISED + " raw_payload:s"


SENT = columns.NORMALISED + " sent_title:s sent_revision:s sent_length:s sent_timestamp:s"


@register("normalise_wiki_changes", SENT, "edits")
def _(spark, sf_dir):
    sent = lambda path: F.get_json_object("raw_payload", path)
    return normalise.normalise_wiki_changes(
        inputs.wiki_changes(spark, sf_dir), INGEST_TIME,
    ).withColumns({
        "sent_title": sent("$.title"), "sent_revision": sent("$.revision.new"),
        "sent_length": sent("$.length.new"), "sent_timestamp": sent("$.timestamp")})


@register("normalise_wiki_pageviews", PAYLOAD, "views")
def _(spark, sf_dir):
    return normalise.normalise_wiki_pageviews(
        inputs.pageviews(spark, sf_dir), ingest_time=INGEST_TIME)


@register("normalise_wiki_pageviews_top", PAYLOAD, "views_top")
def _(spark, sf_dir):
    return normalise.normalise_wiki_pageviews(
        inputs.pageviews(spark, sf_dir), top_n=200, ingest_time=INGEST_TIME)


@register("normalise_gdelt_live", PAYLOAD, "news_live")
def _(spark, sf_dir):
    return normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "live", INGEST_TIME)


@register("normalise_gdelt_backfill", PAYLOAD, "news_backfill")
def _(spark, sf_dir):
    return normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME)


@register("normalise_gdelt_quoted_breaks", columns.NORMALISED, "", sql=oracle.query(
    "SELECT " + columns.select_list(columns.NORMALISED)
    + " FROM (SELECT * REPLACE (replace(topic, 'ACTOR ', E'ACTOR\n') AS topic) FROM news_live)"))
def _(spark, sf_dir):
    # Export files whose quoted fields hold line breaks, tabs between them and doubled quotes.
    exports = shared_dir(spark, "exports")
    inputs.gdelt_lines(spark, sf_dir).select(F.regexp_replace(
        "line", "ACTOR ([0-9]+)", '"ACTOR\n$1"')).repartition(4).write.text(exports)
    return normalise.normalise_gdelt(
        landed.read_gdelt_exports(spark, exports, multi_line=True), "live", INGEST_TIME)


@register("normalise_arxiv_feed", PAYLOAD, "papers_feed")
def _(spark, sf_dir):
    return normalise.normalise_arxiv(
        inputs.arxiv_entries(spark, sf_dir, "rfc822"), "feed", ingest_time=INGEST_TIME)


@register("normalise_arxiv_feed_top", PAYLOAD, "papers_feed_top")
def _(spark, sf_dir):
    return normalise.normalise_arxiv(
        inputs.arxiv_entries(spark, sf_dir, "rfc822"), "feed", max_per_category=200,
        ingest_time=INGEST_TIME, max_authors=10, max_summary=500)


@register("normalise_arxiv_backfill", PAYLOAD, "papers_backfill")
def _(spark, sf_dir):
    return normalise.normalise_arxiv(
        inputs.arxiv_entries(spark, sf_dir, "iso"), "backfill", ingest_time=INGEST_TIME)


@register(
    "classify_topic", "doc_id:i text_category:s source_category:s", "",
    sql=f"SELECT doc_id, {oracle._topic_of('text')} AS text_category, "
        f"{oracle._topic_of('source')} AS source_category FROM documents")
def _(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", classify_topic(F.col("text")).alias("text_category"),
        classify_topic(F.col("source")).alias("source_category"))


@register(
    "cameo_to_category", "id:s category:s", "",
    sql=oracle.query("SELECT id, " + oracle._mapped(
        "left(code, 2)", oracle.CAMEO_CATEGORY, "uncategorised")
        + " AS category FROM export_fields"))
def _(spark, sf_dir):
    field = F.split("line", "\t")
    return inputs.gdelt_lines(spark, sf_dir).filter(F.size(field) >= 58).select(
        field[0].alias("id"), cameo_to_category(field[26]).alias("category"))


@register(
    "arxiv_to_category", "category:s topic_category:s papers:i", "",
    sql=oracle.query("SELECT category, " + oracle._mapped(
        "lower(split_part(category, '.', 1))", oracle.ARXIV_CATEGORY, "science")
        + " AS topic_category, count(*) AS papers FROM entries GROUP BY ALL"))
def _(spark, sf_dir):
    return (
        inputs.arxiv_entries(spark, sf_dir, "iso")
        .groupBy("category", arxiv_to_category(F.col("category")).alias("topic_category"))
        .agg(F.count("*").alias("papers")))


@register(
    "make_event_id", "event_id:i hashed:s", "",
    sql="SELECT event_id, left(sha256(event_type || ':' || event_id || ':' || props), 32) "
        "AS hashed FROM events")
def _(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", make_event_id(*map(F.col, ["event_type", "event_id", "props"])).alias("hashed"))


DELIVERED = "event_id:s source:s event_timestamp:t event_date:d topic:s ingested_at:t"


@register("dedupe_events", DELIVERED, "delivered_once")
def _(spark, sf_dir):
    return dedupe_events(inputs.redelivered_events(spark, sf_dir))


MESSAGE = (
    "key:s kafka_topic:s event_id:s source:s event_timestamp:s topic:s topic_category:s "
    "language:s country_code:s signal_strength:x medium_type:s raw_payload:s ingested_at:s"
)


@register("to_envelope", MESSAGE, "", sql=oracle.query(f"""
SELECT {columns.select_list(MESSAGE)} FROM (
  SELECT * REPLACE (strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS event_timestamp,
      strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ingested_at,
      to_json({{'code': raw_payload->>'$.code', 'raw_id': raw_payload->>'$.raw_id'}})
        AS raw_payload),
    topic AS key, 'gdelt_events' AS kafka_topic
  FROM (FROM news_backfill))"""))
def _(spark, sf_dir):
    sent = envelope.to_envelope(
        normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME))
    received = "event_id string, source string, event_timestamp string, topic string, " \
        "topic_category string, language string, country_code string, signal_strength double, " \
        "medium_type string, raw_payload string, ingested_at string"
    return sent.select(
        "key", F.col("topic").alias("kafka_topic"),
        F.from_json(F.col("value").cast("string"), received).alias("event"),
    ).select("key", "kafka_topic", "event.*")


SENT_ALL = MESSAGE.replace(" raw_payload:s", "")
_SENT_KEY = {"edits": "topic", "views": "topic", "news_backfill": "topic",
             "papers_feed": "raw_payload->>'$.category'"}
_KAFKA_TOPIC = "CASE source WHEN 'gdelt' THEN 'gdelt_events' WHEN 'arxiv' THEN 'arxiv_papers' ELSE source END"


def _sent_sql(*views: str) -> str:
    """The messages of views of events."""
    return " UNION ALL ".join(f"""
SELECT {columns.select_list(SENT_ALL)} FROM (
  SELECT * REPLACE (strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS event_timestamp,
      strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ingested_at),
    {_SENT_KEY[view]} AS key, {_KAFKA_TOPIC} AS kafka_topic
  FROM (FROM {view}))""" for view in views)


def _received(messages: DataFrame) -> DataFrame:
    """Messages parsed again, without their payloads."""
    received = "event_id string, source string, event_timestamp string, topic string, " \
        "topic_category string, language string, country_code string, signal_strength double, " \
        "medium_type string, ingested_at string"
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("topic").alias("kafka_topic"),
        F.from_json(F.col("value").cast("string"), received).alias("event"),
    ).select("key", "kafka_topic", "event.*")


@register("to_envelope_sources", SENT_ALL, "", sql=oracle.query(_sent_sql(*_SENT_KEY)))
def _(spark, sf_dir):
    events = [
        normalise.normalise_wiki_changes(inputs.wiki_changes(spark, sf_dir), INGEST_TIME),
        normalise.normalise_wiki_pageviews(
            inputs.pageviews(spark, sf_dir), ingest_time=INGEST_TIME),
        normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME),
        normalise.normalise_arxiv(
            inputs.arxiv_entries(spark, sf_dir, "rfc822"), "feed", ingest_time=INGEST_TIME)]
    return _received(envelope.to_envelope(reduce(DataFrame.unionByName, events)))


@register(
    "validate_envelope", "event_id:s source:s topic_category:s medium_type:s reject_reason:s",
    "validated")
def _(spark, sf_dir):
    return envelope.validate_envelope(inputs.messages(spark, sf_dir))


RAW = columns.NORMALISED


@register("filter_date_range", RAW, "raw_events",
          "event_date >= DATE '2024-01-10' AND event_date <= DATE '2024-01-19'")
def _(spark, sf_dir):
    return envelope.filter_date_range(
        inputs.raw_events(spark, sf_dir), "2024-01-10", "2024-01-19")


@register("filter_trailing_days", RAW, "raw_events",
          f"event_date BETWEEN DATE '{AS_OF}' - INTERVAL 20 DAY AND DATE '{AS_OF}'")
def _(spark, sf_dir):
    return envelope.filter_date_range(inputs.raw_events(spark, sf_dir), days=20, as_of=AS_OF)


# --- stream enrichment, on batches ------------------------------------------

PARSED = columns.ENVELOPE.replace("event_timestamp:t event_date:d ", "")


@register("parse_envelope", PARSED + " kafka_topic:s", "message_fields")
def _(spark, sf_dir):
    return enrich.parse_envelope(inputs.messages(spark, sf_dir))


@register("with_event_time", columns.ENVELOPE, "leveled")
def _(spark, sf_dir):
    return enrich.with_event_time(enrich.parse_envelope(inputs.messages(spark, sf_dir)))


@register("consciousness_level", "event_id:s consciousness_level:s", "leveled")
def _(spark, sf_dir):
    return enrich.parse_envelope(inputs.messages(spark, sf_dir)).select(
        "event_id",
        consciousness_level(F.col("topic_category"), F.col("source")).alias("consciousness_level"))


@register("medium_dominance", "event_id:s medium_dominance:s", "dominated")
def _(spark, sf_dir):
    return enrich.parse_envelope(inputs.messages(spark, sf_dir)).select(
        "event_id",
        medium_dominance(F.col("medium_type"), F.col("signal_strength")).alias("medium_dominance"))


@register("adjusted_signal", "event_id:s signal_strength:x", "enriched")
def _(spark, sf_dir):
    return enrich.parse_envelope(inputs.messages(spark, sf_dir)).select(
        "event_id",
        adjusted_signal(F.col("signal_strength"), F.col("source"), F.col("topic_category"))
        .alias("signal_strength"))


@register("parse_and_enrich", columns.ENRICHED, "enriched")
def _(spark, sf_dir):
    return enrich.parse_and_enrich(inputs.messages(spark, sf_dir))


# --- streams ----------------------------------------------------------------

def _message_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    path = shared_dir(spark, "messages")
    inputs.messages(spark, sf_dir).repartition(4).write.parquet(path)
    return source.read_landed_stream(spark, path, max_files)


@register("read_landed_stream", PARSED + " kafka_topic:s", "message_fields")
def _(spark, sf_dir):
    out = shared_dir(spark, "parsed")
    parsed = enrich.parse_envelope(_message_stream(spark, sf_dir, max_files=1))
    (parsed.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", shared_dir(spark, "offsets"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(parsed.schema).parquet(out)


def _enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.parse_and_enrich(_message_stream(spark, sf_dir, max_files=2))


@register("write_lake", columns.ENRICHED, "enriched")
def _(spark, sf_dir):
    out = shared_dir(spark, "lake")
    events = _enriched_stream(spark, sf_dir)
    sinks.write_lake(events, out, shared_dir(spark, "offsets"), trigger=None).awaitTermination()
    return tables.read_table(spark, out, events)


@register("write_warehouse", columns.ENRICHED, "enriched")
def _(spark, sf_dir):
    out = shared_dir(spark, "warehouse")
    events = _enriched_stream(spark, sf_dir)
    sinks.write_warehouse(
        events, out, shared_dir(spark, "offsets"), trigger=None).awaitTermination()
    return tables.read_table(spark, out, events)


@register(
    "run_dual_sink", columns.ENRICHED + " sink:s", "",
    sql=oracle.query(
        f"SELECT {columns.select_list(columns.ENRICHED)}, sink FROM enriched, "
        "(VALUES ('lake'), ('warehouse')) AS sinks(sink)"))
def _(spark, sf_dir):
    lake, warehouse = shared_dir(spark, "lake"), shared_dir(spark, "warehouse")
    events = _enriched_stream(spark, sf_dir)
    for query in sinks.run_dual_sink(
            events, lake, warehouse, shared_dir(spark, "offsets"), trigger=None):
        query.awaitTermination()
    return (
        tables.read_table(spark, lake, events).withColumn("sink", F.lit("lake"))
        .unionByName(
            tables.read_table(spark, warehouse, events).withColumn("sink", F.lit("warehouse"))))


@register(
    "dedupe_events_stream", "event_id:s source:s event_timestamp:t event_date:d topic:s",
    "delivered_once")
def _(spark, sf_dir):
    # Four micro-batches, the latest events first: most rows are days late.
    landed, out = shared_dir(spark, "delivered"), shared_dir(spark, "distinct")
    events = inputs.redelivered_events(spark, sf_dir)
    for days in ("> '2024-01-20'", "between '2024-01-11' and '2024-01-20'", "< '2024-01-11'"):
        events.filter(f"event_date {days}").coalesce(1).write.mode("append").parquet(landed)
    events.filter("event_id is not null").coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    (enrich.dedupe_stream(events).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", shared_dir(spark, "offsets"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(schema).parquet(out)


@register(
    "dedupe_events_exact_stream", "event_id:s source:s event_timestamp:t event_date:d topic:s",
    "delivered_once")
def _(spark, sf_dir):
    # As above, but with a restart before the copies, and a memory without an end.
    path, out, offsets, ids = (shared_dir(spark, p) for p in ("delivered", "out", "offsets", "ids"))
    events = inputs.redelivered_events(spark, sf_dir)
    for some in ("event_date > '2024-01-20'", "event_date <= '2024-01-20'", "event_id is not null"):
        events.filter(some).write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.schema).parquet(path)
        seen.start_exact_dedupe(stream, out, offsets, ids, fan_in=2, trigger=None).awaitTermination()
    return tables.read_table(spark, out, events)


@register("feed_messages", SENT_ALL, "", sql=oracle.query(_sent_sql("edits", "views")))
def _(spark, sf_dir):
    # Two feeds, files as micro-batches; the jobs end when there is nothing more and start
    # again when new files have landed.
    out = shared_dir(spark, "messages")
    for feed, records in (("wiki_changes", inputs.wiki_changes(spark, sf_dir)),
                          ("wiki_pageviews", inputs.pageviews(spark, sf_dir))):
        path, offsets = shared_dir(spark, feed), shared_dir(spark, "offsets")
        for part in range(2):
            some = F.pmod(F.xxhash64(*records.columns), F.lit(2)) == part
            records.filter(some).repartition(2).write.mode("append").json(path)
            feeds.write_messages(
                feeds.feed_messages(spark, feed, path, INGEST_TIME, max_files=1), offsets,
                path=out, trigger=None).awaitTermination()
    return _received(spark.read.parquet(out))


@register("first_per_hour_stream", PAYLOAD, "views_top")
def _(spark, sf_dir):
    # The lists of some hours per landing; an hour at its edge comes in two micro-batches.
    path, out = shared_dir(spark, "feed"), shared_dir(spark, "first")
    pages = inputs.pageviews(spark, sf_dir)
    at = F.floor((F.unix_timestamp("hour") - 1704067200) / 3600) + F.col("rank") % 2
    hours = pages.agg(F.max(at)).first()[0] + 1
    for part in range(3):
        pages.filter(F.floor(at * 3 / hours) == part).write.mode("append").json(path)
        records = landed.read_wiki_pageviews(spark, path, stream=True)
        if part == 0:
            offsets = shared_dir(spark, "offsets")
        feeds.start_first_per_hour(
            records, out, offsets, 200, [F.col("rank"), F.col("article"), F.col("views")],
            trigger=None).awaitTermination()
    first = feeds.read_first_per_hour(spark, out, pages, closed_only=False)
    return normalise.normalise_wiki_pageviews(first, ingest_time=INGEST_TIME)


# --- tables -----------------------------------------------------------------

@register("load_lake_to_raw", columns.ENVELOPE, "enriched")
def _(spark, sf_dir):
    # A load, one without new files, and one with late files for old dates.
    lake, raw, offsets, landed, loaded = (
        shared_dir(spark, p) for p in ("lake", "raw", "offsets", "messages", "loaded"))
    sent = inputs.messages(spark, sf_dir)
    for late in (False, True):
        sent.filter((F.col("topic") == "gdelt_events") == F.lit(late)).write.mode("append") \
            .parquet(landed)
        events = enrich.parse_and_enrich(source.read_landed_stream(spark, landed))
        sinks.write_lake(events, lake, offsets, trigger=None).awaitTermination()
        for _again in range(2):
            rows = tables.load_lake_to_raw(spark, lake, raw, loaded)
    return rows


_NO_LEVELS = "NULL AS consciousness_level, NULL AS medium_dominance"


@register("raw_table_writers", columns.ENRICHED, "", sql=oracle.query(
    f"SELECT {columns.select_list(columns.ENRICHED)} FROM enriched UNION ALL "
    + " UNION ALL ".join(f"SELECT {columns.select_list(columns.ENVELOPE)}, {_NO_LEVELS} FROM {view}"
                         for view in ("enriched", "news_backfill"))))
def _(spark, sf_dir):
    # Stream, lake load and a backfill delivered twice, in one table; then closed days merge.
    # Only the stream writes levels; they stay, also in merged days.
    lake, raw, offsets, loaded = (
        shared_dir(spark, p) for p in ("lake", "raw", "offsets", "loaded"))
    events = _enriched_stream(spark, sf_dir)
    for query in sinks.run_dual_sink(events, lake, raw, offsets, trigger=None):
        query.awaitTermination()
    tables.load_lake_to_raw(spark, lake, raw, loaded)
    news = normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME)
    for _again in range(2):
        tables.append_backfill(news, raw, "news")
    tables.compact(spark, raw, dt.date(2024, 1, 20))
    return tables.read_raw(spark, raw)


@register("compact_after_a_stop", columns.ENRICHED, "", sql=oracle.query(
    f"SELECT {columns.select_list(columns.ENRICHED)} FROM enriched UNION ALL "
    f"SELECT {columns.select_list(columns.ENVELOPE)}, {_NO_LEVELS} FROM news_backfill"))
def _(spark, sf_dir):
    # A compaction decides what to do and stops with one day done; the next one finishes it.
    table, offsets = shared_dir(spark, "raw"), shared_dir(spark, "offsets")
    events = _enriched_stream(spark, sf_dir)
    sinks.write_warehouse(events, table, offsets, trigger=None).awaitTermination()
    tables.append_backfill(
        normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME),
        table)
    (first, *_) = raw.begin_compaction(spark, table, dt.date(2024, 1, 20))
    storage = Storage(spark, table)
    (aside,) = (e.name for e in storage.entries(table) if e.name.startswith(raw.ASIDE))
    (merged,) = (name for _, name in storage.folders(f"{table}/{aside}/event_date={first}", "batch"))
    storage.move(f"{table}/{aside}/event_date={first}/{merged}", f"{table}/event_date={first}/{merged}")
    stopped = pin(tables.read_raw(spark, table))
    tables.compact(spark, table, dt.date(2024, 1, 20))
    finished = tables.read_raw(spark, table)
    # The same rows before and after: what only one of them has shows up besides.
    return finished.unionByName(stopped.exceptAll(finished)).unionByName(finished.exceptAll(stopped))


EVOLVED = columns.ENVELOPE + " views:n region:s"


@register("load_lake_evolved", EVOLVED, "", sql=oracle.query(f"""
    SELECT {columns.select_list(columns.ENVELOPE)},
      CAST(CASE WHEN event_date > '2024-01-20' THEN CAST(event_id AS BIGINT) * 5000000000
        WHEN event_date > '2024-01-10' THEN CAST(event_id AS BIGINT) END AS DOUBLE) AS views,
      CASE WHEN event_date > '2024-01-20' THEN source END AS region
    FROM raw_events"""))
def _(spark, sf_dir):
    # Three loads: known columns, one column more, that column wider and another one.
    lake_path, table, loaded = (shared_dir(spark, p) for p in ("lake", "raw", "loaded"))
    events = inputs.raw_events(spark, sf_dir)
    number = F.col("event_id").cast("bigint")
    for days, added in (
        ("<= '2024-01-10'", {}),
        ("between '2024-01-11' and '2024-01-20'", {"views": number.cast("int")}),
        ("> '2024-01-20'", {"views": number * F.lit(5_000_000_000), "region": F.col("source")}),
    ):
        events.filter(f"event_date {days}").withColumns(added).write.mode("append").partitionBy(
            "event_date").parquet(lake_path)
        rows = tables.load_lake_to_raw(spark, lake_path, table, loaded, merge_schema=True)
    return rows


@register("expire_streamed_lake", columns.ENVELOPE, "enriched",
          f"event_date IS NULL OR event_date >= DATE '{AS_OF}' - INTERVAL 25 DAY "
          "OR source = 'gdelt'")
def _(spark, sf_dir):
    # The stream writes, days expire, the stream goes on with late rows, the lake is loaded.
    landed, lake_path, offsets, table, loaded = (
        shared_dir(spark, p) for p in ("messages", "lake", "offsets", "raw", "loaded"))
    sent = inputs.messages(spark, sf_dir)
    for news in (False, True):
        sent.filter((F.col("topic") == "gdelt_events") == F.lit(news)).write.mode("append") \
            .parquet(landed)
        events = enrich.parse_and_enrich(source.read_landed_stream(spark, landed))
        sinks.write_lake(events, lake_path, offsets, trigger=None).awaitTermination()
        if not news:
            tables.expire_partitions(spark, lake_path, dt.date.fromisoformat(AS_OF), days=25)
    return tables.load_lake_to_raw(spark, lake_path, table, loaded)


@register("append_backfill", PAYLOAD, "", sql=oracle.query(
    f"SELECT {columns.select_list(PAYLOAD)} FROM news_backfill UNION ALL "
    f"SELECT {columns.select_list(PAYLOAD)} FROM papers_backfill"))
def _(spark, sf_dir):
    raw = shared_dir(spark, "raw")
    tables.append_backfill(
        normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir), "backfill", INGEST_TIME), raw)
    return tables.append_backfill(
        normalise.normalise_arxiv(
            inputs.arxiv_entries(spark, sf_dir, "iso"), "backfill", ingest_time=INGEST_TIME), raw)


@register("materialise", columns.FACT, "fact")
def _(spark, sf_dir):
    return tables.materialise(
        _fact(spark, sf_dir), shared_dir(spark, "fact"), "event_date",
        ("source", "topic_category"))


@register("retain", RAW, "raw_events", f"event_date >= DATE '{AS_OF}' - INTERVAL 25 DAY")
def _(spark, sf_dir):
    return tables.retain(inputs.raw_events(spark, sf_dir), AS_OF, days=25)


@register("expire_partitions", RAW, "raw_events",
          f"event_date >= DATE '{AS_OF}' - INTERVAL 25 DAY")
def _(spark, sf_dir):
    raw = shared_dir(spark, "raw")
    tables.append_backfill(inputs.raw_events(spark, sf_dir), raw)
    tables.expire_partitions(spark, raw, dt.date.fromisoformat(AS_OF), days=25)
    return tables.read_raw(spark, raw)


# --- staging, fact, aggregate -----------------------------------------------

@register("stg_wikipedia", columns.STAGED, "staged_wikipedia")
def _(spark, sf_dir):
    return stg_wikipedia(inputs.raw_events(spark, sf_dir), AS_OF)


@register("stg_gdelt", columns.STAGED, "staged_gdelt")
def _(spark, sf_dir):
    return stg_gdelt(inputs.raw_events(spark, sf_dir), AS_OF)


@register("stg_arxiv", columns.STAGED, "staged_arxiv")
def _(spark, sf_dir):
    return stg_arxiv(inputs.raw_events(spark, sf_dir), AS_OF)


@register("fact_attention_events", columns.FACT, "fact")
def _(spark, sf_dir):
    raw = inputs.raw_events(spark, sf_dir)
    return fact.fact_attention_events(
        stg_wikipedia(raw, AS_OF), stg_gdelt(raw, AS_OF), stg_arxiv(raw, AS_OF))


@register("fact_from_raw", columns.FACT, "fact")
def _(spark, sf_dir):
    return _fact(spark, sf_dir)


@register("daily_rollup", columns.ROLLUP, "rollup")
def _(spark, sf_dir):
    return aggregate.daily_rollup(_fact(spark, sf_dir))


@register("agg_daily_attention", columns.AGG, "agg")
def _(spark, sf_dir):
    return _agg(spark, sf_dir)


@register(
    "daily_noospheric_density", "event_date:d noospheric_density:r", "",
    sql=oracle.query(
        "SELECT CAST(event_date AS VARCHAR) AS event_date, "
        "round(sum(noospheric_density), 9) AS noospheric_density FROM agg GROUP BY event_date"))
def _(spark, sf_dir):
    return aggregate.daily_noospheric_density(_agg(spark, sf_dir))


# --- metrics ----------------------------------------------------------------

@register("synchronicity_score", columns.SYNC, "sync")
def _(spark, sf_dir):
    return metrics.synchronicity_score(_agg(spark, sf_dir))


@register(
    "synchronicity_band", "event_date:d topic_category:s band:s", "",
    sql=oracle.query(
        "SELECT CAST(event_date AS VARCHAR) AS event_date, topic_category, "
        "CASE WHEN synchronicity_score >= 0.8 THEN 'Synchronic' "
        "WHEN synchronicity_score >= 0.5 THEN 'Convergent' "
        "WHEN synchronicity_score >= 0.2 THEN 'Coherent' ELSE 'Fragmented' END AS band "
        "FROM sync"))
def _(spark, sf_dir):
    return metrics.synchronicity_score(_agg(spark, sf_dir)).withColumn(
        "band", metrics.synchronicity_band(F.col("synchronicity_score")))


@register("shadow_index", columns.SHADOW, "shadow")
def _(spark, sf_dir):
    return metrics.shadow_index(_agg(spark, sf_dir))


@register("consciousness_level_daily", columns.LEVEL, "level")
def _(spark, sf_dir):
    return metrics.consciousness_level_daily(_fact(spark, sf_dir))


# --- dashboard and quality --------------------------------------------------

@register("dashboard_tile1", columns.TILE1, "tile1")
def _(spark, sf_dir):
    return dashboard.dashboard_tile1(_fact(spark, sf_dir), AS_OF)


@register("dashboard_tile2", columns.MART, "tile2")
def _(spark, sf_dir):
    rollup = pin(aggregate.daily_rollup(_fact(spark, sf_dir)))
    agg = aggregate.agg_daily_attention(rollup)
    return dashboard.dashboard_tile2(
        metrics.synchronicity_score(agg), metrics.shadow_index(agg),
        metrics.consciousness_level_daily(rollup), agg, AS_OF)


@register("mart_dashboard", columns.MART, "mart")
def _(spark, sf_dir):
    return _mart(spark, sf_dir, AS_OF)


@register(
    "tile1_chart", "topic_category:s medium_dominance:s event_count:i", "",
    sql=oracle.query(
        "SELECT topic_category, medium_dominance, CAST(sum(event_count) AS BIGINT) AS event_count "
        "FROM tile1 GROUP BY topic_category, medium_dominance"))
def _(spark, sf_dir):
    return dashboard.tile1_chart(_mart(spark, sf_dir, AS_OF))


@register(
    "tile2_series", "event_date:d total_signal:r shadow_index:r", "",
    sql=oracle.query(
        "SELECT CAST(event_date AS VARCHAR) AS event_date, "
        "round(avg(total_signal), 9) + 0.0 AS total_signal, "
        "round(avg(shadow_index), 9) + 0.0 AS shadow_index "
        "FROM tile2 GROUP BY event_date"))
def _(spark, sf_dir):
    return dashboard.tile2_series(_mart(spark, sf_dir, AS_OF))


@register("recent_kairos_events", columns.SYNC, "sync",
          f"is_kairos_event AND event_date >= DATE '{QUALITY_DAY}' - INTERVAL 7 DAY")
def _(spark, sf_dir):
    return dashboard.recent_kairos_events(
        metrics.synchronicity_score(_agg(spark, sf_dir)), QUALITY_DAY)


QUALITY = "yesterday_rows:i invalid_sync_scores:i active_categories:i"


@register("quality_metrics", QUALITY, "quality_early")
def _(spark, sf_dir):
    return quality.quality_metrics(_mart(spark, sf_dir, QUALITY_DAY), QUALITY_DAY)


def _checks_sql(view: str) -> str:
    return oracle.query(
        "SELECT 'yesterday_rows' AS \"check\", yesterday_rows > 0 AS passed, "
        f"yesterday_rows AS actual FROM {view} UNION ALL "
        "SELECT 'invalid_sync_scores', invalid_sync_scores = 0, invalid_sync_scores "
        f"FROM {view} UNION ALL "
        f"SELECT 'active_categories', active_categories >= 4, active_categories FROM {view}")


@register("assert_quality", "check:s passed:b actual:i", "", sql=_checks_sql("quality_early"))
def _(spark, sf_dir):
    return quality.assert_quality(
        quality.quality_metrics(_mart(spark, sf_dir, QUALITY_DAY), QUALITY_DAY))


@register("assert_quality_stale", "check:s passed:b actual:i", "", sql=_checks_sql("quality"))
def _(spark, sf_dir):
    return quality.assert_quality(quality.quality_metrics(_mart(spark, sf_dir, AS_OF), AS_OF))


@register("run_daily", columns.MART, "mart")
def _(spark, sf_dir):
    return run_daily(inputs.raw_events(spark, sf_dir), AS_OF).mart_dashboard


@register("rebuild_tables_staging", columns.STAGED, "staged_gdelt")
def _(spark, sf_dir):
    return rebuild_tables(
        inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse"), AS_OF,
        raw_by_date=False, staging=True).stg_gdelt


@register("rebuild_tables_level", columns.LEVEL, "level")
def _(spark, sf_dir):
    return rebuild_tables(
        inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse"), AS_OF,
        raw_by_date=False).consciousness_level


@register("refresh_tables", columns.FACT, "fact")
def _(spark, sf_dir):
    # A first run with one day missing and one day too many, then a refresh on the right rows.
    events, root = inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse")
    extra = events.filter("event_date = '2024-01-20'").withColumns({
        c: F.col(c) + F.expr("interval 12 days") for c in ("event_date", "event_timestamp")
    }).withColumn("event_date", F.col("event_date").cast("date"))
    rebuild_tables(
        events.filter("event_date <> '2024-01-25'").unionByName(extra), root, AS_OF,
        raw_by_date=False)
    return refresh_tables(
        events, root, dt.date.fromisoformat(AS_OF), since=dt.date(2024, 1, 18),
        raw_by_date=False).fact_attention_events


@register("refresh_changed", columns.FACT, "fact")
def _(spark, sf_dir):
    # A first run; then new days and rows weeks late arrive. Which days changed follows from
    # the files that arrived.
    events = inputs.raw_events(spark, sf_dir)
    table, root = shared_dir(spark, "raw"), shared_dir(spark, "warehouse")
    late = (F.col("source") == "gdelt") & (F.col("event_date") < F.lit("2024-01-05"))
    known = F.col("event_date") <= F.lit("2024-01-25")
    for part in (known & ~late, ~known, late):
        tables.append_backfill(events.filter(part), table)
        run = refresh_changed(spark, table, root, dt.date.fromisoformat(AS_OF))
    return run.fact_attention_events


@register("rebuild_tables_checked", columns.MART, "mart")
def _(spark, sf_dir):
    # A sound run is published; a later one on less events fails its checks and is not.
    events, root = inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse")
    rebuild_tables(events, root, AS_OF, raw_by_date=False)
    try:
        rebuild_tables(events.filter("topic_category = 'science'"), root, AS_OF,
                       raw_by_date=False, checked=True)
    except NotPublished:
        return read_daily(spark, root, "mart_dashboard")
    raise AssertionError("a mart of one category passed")

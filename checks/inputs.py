"""Feed-shaped input views over the given tables; oracle.py derives the same in SQL.

Signals are multiples of 1/1024, so that their sums are exact in any order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2024-02-10"
QUALITY_DAY = "2024-01-31"
INGEST_TIME = dt.datetime(2024, 3, 1, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event table."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as event_id",
        "case event_type when 'view' then 'wiki_pageviews' when 'click' then 'wiki_changes'"
        " when 'error' then 'gdelt' when 'purchase' then 'arxiv' else 'other' end as source",
        "cast(ts as timestamp) as event_timestamp",
        "cast(ts as date) as event_date",
        "case event_id % 50 when 0 then null when 1 then '\\t ab\\n'"
        " when 2 then concat('[WITHDRAWN] paper ', event_id)"
        " else concat(' Topic ', event_id, ' ') end as topic",
        "case user_id % 8 when 0 then 'science' when 1 then 'conflict' when 2 then ' Health '"
        " when 3 then 'environment' when 4 then 'CULTURE' when 5 then 'economics'"
        " when 6 then 'uncategorised' end as topic_category",
        "' EN ' as language",
        "case user_id % 3 when 0 then ' us\\t' when 1 then 'fr' end as country_code",
        "case when event_id % 97 = 0 then null when event_id % 89 = 0 then 1 + value"
        " else floor(least(value / 50, 1) * 1024) / 1024 end as signal_strength",
        "case event_type when 'view' then ' Collective_Memory ' when 'click' then"
        " 'collective_memory' when 'error' then 'institutional_media' when 'purchase' then"
        " 'formal_knowledge' end as medium_type",
        "cast(ts as timestamp) + interval 60 seconds as ingested_at",
    )


def redelivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events with every page view delivered again an hour later; some without id."""
    events = raw_events(spark, sf_dir)
    again = events.filter("source = 'wiki_pageviews'").selectExpr(
        *[c for c in events.columns if c != "ingested_at"],
        "ingested_at + interval 1 hour as ingested_at")
    return again.unionByName(events).withColumn(
        "event_id", F.expr("case when cast(event_id as bigint) % 101 <> 0 then event_id end"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream messages: the raw events as JSON, some malformed or incomplete."""
    return raw_events(spark, sf_dir).selectExpr(
        "source", "cast(event_id as bigint) % 5 as flaw",
        "struct(event_id, case when source <> 'other' or cast(event_id as bigint) % 5 <> 1"
        " then source end as source,"
        " case when source = 'other' and cast(event_id as bigint) % 5 = 2 then 'yesterday'"
        " else date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\") end"
        " as event_timestamp,"
        " topic, case when source = 'other' and cast(event_id as bigint) % 5 = 3 then ''"
        " else topic_category end as topic_category, language, country_code, signal_strength,"
        " case when source = 'other' and cast(event_id as bigint) % 5 = 4 then ''"
        " else medium_type end as medium_type) as body",
    ).selectExpr(
        "cast(case when source = 'other' and flaw = 0 then '{\"event_id\": ' else to_json(body) end"
        " as binary) as value",
        "case source when 'gdelt' then 'gdelt_events' when 'arxiv' then 'arxiv_papers'"
        " else source end as topic",
    )


def wiki_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records."""
    return table(spark, sf_dir, "documents").selectExpr(
        "case source when 'src19' then null when 'src18' then 1 else 0 end as namespace",
        "case source when 'src17' then true when 'src16' then null else false end as bot",
        "concat(element_at(array('science', 'WAR of', 'Health', 'climate', 'history',"
        " 'trade', 'software', 'Spain', 'mental', 'energy', 'quiet', 'Election'),"
        " cast(doc_id % 12 + 1 as int)), ' ', lang, ' ', doc_id) as title",
        "case lang when 'es' then null when 'de' then 'wiki' else concat(lang, 'wiki') end as wiki",
        "case source when 'src15' then null else 1704067200 + doc_id * 60 end as timestamp",
        "case source when 'src14' then null else named_struct('new', doc_id * 7 + 1) end"
        " as revision",
        "named_struct('new', case source when 'src13' then null else n_chars end,"
        " 'old', case source when 'src12' then null else doc_id % 7 * 1000 end) as length",
    )


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most-read lists of 240 articles per hour, read at minutes 0, 10 and 20."""
    return table(spark, sf_dir, "pages").selectExpr(
        "timestamp_seconds(1704067200 + page_id div 240 * 3600 + page_id % 3 * 600) as hour",
        "cast(240 - page_id % 240 as int) as rank",
        "replace(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ', '_') as article",
        "cast(length(html) as bigint) * (page_id % 500) as views",
    )


def gdelt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export lines of 61 fields, some cut to 57."""
    fields = {
        0: "cast(event_id as string)",
        1: "case user_id % 10 when 0 then date_format(ts, 'yyyyMMdd') when 1 then 'soon'"
           " else date_format(ts, 'yyyyMMddHHmmss') end",
        6: "case event_type when 'view' then '' else concat('ACTOR ', user_id) end",
        16: "case when event_type = 'view' and user_id % 2 = 1 then ''"
            " else concat('PARTNER ', user_id) end",
        26: "element_at(array('14', '180', '0190', '20', '010', '02', '036', '07', '08', '10',"
            " '051', '04', '1', ''), cast(user_id % 14 + 1 as int))",
        33: "cast(event_id % 40 as string)",
        34: "case when value < 1 then 'n/a' else"
            " cast(cast(100 - value as decimal(9, 2)) as string) end",
        37: "element_at(array('USA', 'FR', 'D', ''), cast(user_id % 4 + 1 as int))",
    }
    row = ", ".join(fields.get(i, "''") for i in range(61))
    width = "case when event_type = 'signup' and value > 100 then 57 else 61 end"
    return table(spark, sf_dir, "events").selectExpr(
        f"concat_ws('\\t', slice(array({row}), 1, {width})) as line")


def arxiv_entries(spark: SparkSession, sf_dir: str, dates: str) -> DataFrame:
    """Feed entries with RFC-822 or ISO dates; about a third are in one category."""
    moment = "timestamp_seconds(1704067200 + doc_id * 3600)"
    shown = {
        "rfc822": f"concat(date_format({moment}, 'EEE, dd MMM yyyy HH:mm:ss'), ' -0500')",
        "iso": f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    }[dates]
    return table(spark, sf_dir, "documents").selectExpr(
        "case source when 'src19' then null when 'src18' then ''"
        " else concat('http://arxiv.org/abs/', doc_id, 'v1') end as id",
        "case source when 'src17' then ' \\n ' else"
        " concat('\\n On ', lang, '\\n', source, ' ', doc_id, '\\t') end as title",
        f"case source when 'src16' then 'not a date' when 'src15' then null else {shown} end"
        " as published",
        "case when doc_id % 25 = 0 then null else"
        " transform(sequence(1, cast(doc_id % 25 as int)),"
        " i -> named_struct('name', concat('Author ', i))) end as authors",
        "text as summary",
        "case when source in ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6')"
        " then 'cs.AI' when source in ('src7', 'src8') then 'physics'"
        " when source in ('src9', 'src10') then 'q-bio.NC' when source in ('src11', 'src12')"
        " then 'q-fin.ST' when source = 'src13' then 'econ.GN' when source = 'src14'"
        " then 'Stat.ML' else 'hep-th' end as category",
        "date_add(date'2024-01-01', cast(doc_id div 700 as int)) as feed_date",
        "cast(doc_id % 700 as int) as position",
    )

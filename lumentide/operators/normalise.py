"""Landed feed records to event envelopes, one row in, at most one row out.

Every normaliser yields the columns of the raw event table. Where the record's
date cannot be read the feeds use the time of ingestion, an argument here so that
a rerun gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lumentide.functions import (
    arxiv_to_category, cameo_to_category, clamp_signal, classify_topic, iso_utc, make_event_id,
    parse_compact, parse_iso, parse_rfc822, strip_ws,
)
from lumentide.operators.selection import first_per_group
from lumentide.schemas import GDELT_COLUMNS, GDELT_MIN_COLUMNS, RAW_EVENTS


def _ingest_column(ingest_time: dt.datetime | None) -> Column:
    return F.current_timestamp() if ingest_time is None else F.lit(ingest_time).cast("timestamp")


def _envelope(df: DataFrame, ingest_time: dt.datetime | None, **columns: Column) -> DataFrame:
    columns.setdefault("event_date", F.to_date(columns["event_timestamp"]))
    columns.setdefault("ingested_at", _ingest_column(ingest_time))
    return df.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_EVENTS.fields])


def normalise_wiki_changes(
    changes: DataFrame, ingest_time: dt.datetime | None = None,
) -> DataFrame:
    """Human edits of articles; strength is the changed length, full at 10,000 characters."""
    human = changes.filter((F.col("namespace") == 0) & ~F.coalesce("bot", F.lit(False)))
    ts = F.timestamp_seconds(F.coalesce("timestamp", F.lit(0)))
    title = F.coalesce("title", F.lit(""))
    wiki = F.replace(F.coalesce("wiki", F.lit("enwiki")), F.lit("wiki"), F.lit(""))
    grown = F.coalesce("length.new", F.lit(0)) - F.coalesce("length.old", F.lit(0))
    payload = (F.col("record") if "record" in changes.columns
               else F.to_json(F.struct(*changes.columns)))
    return _envelope(
        human, ingest_time,
        event_id=make_event_id("wiki_changes", F.col("revision.new"), iso_utc(ts)),
        source=F.lit("wiki_changes"),
        event_timestamp=ts,
        topic=title,
        topic_category=classify_topic(title),
        language=F.when(wiki == "", "en").otherwise(wiki),
        country_code=F.lit(None),
        signal_strength=clamp_signal(F.abs(grown) / F.lit(10_000.0)),
        medium_type=F.lit("collective_memory"),
        raw_payload=payload,
    )


def normalise_wiki_pageviews(
    articles: DataFrame, top_n: int | None = None, ingest_time: dt.datetime | None = None,
) -> DataFrame:
    """Articles read in each hour; strength is full at a million views.

    With `top_n` only the first articles of each full hour are taken, in feed order.
    """
    top = articles.select(
        F.date_trunc("hour", "hour").alias("hour"), "rank", "article", "views")
    if top_n is not None:
        top = first_per_group(
            top, ["hour"], [F.col("rank"), F.col("article"), F.col("views")], top_n)
    hour = F.col("hour")
    title = F.replace(F.coalesce("article", F.lit("")), F.lit("_"), F.lit(" "))
    return _envelope(
        top, ingest_time,
        event_id=make_event_id("wiki_pageviews", title, iso_utc(hour)),
        source=F.lit("wiki_pageviews"),
        event_timestamp=hour,
        topic=title,
        topic_category=classify_topic(title),
        language=F.lit("en"),
        country_code=F.lit(None),
        signal_strength=clamp_signal(F.coalesce("views", F.lit(0)) / F.lit(1_000_000.0)),
        medium_type=F.lit("collective_memory"),
        raw_payload=F.to_json(F.struct("article", "views", "rank")),
    )


def _tab_fields(line: Column) -> Column:
    """Fields of a tab-separated line; a field that opens with a quote may hold tabs."""
    quoted = F.regexp_extract_all(line, F.lit('(?:^|\t)("(?:[^"]|"")*"[^\t]*|[^\t]*)'), 1)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, "\t"))


def _unquoted(field: Column) -> Column:
    """A field without its quotes, doubled quotes inside made single."""
    inner = F.regexp_replace(field, '^"((?:[^"]|"")*)"', "$1")
    return F.when(
        field.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def normalise_gdelt(
    lines: DataFrame, mode: str = "live", ingest_time: dt.datetime | None = None,
) -> DataFrame:
    """News events from export lines; strength is the size of the tone, full at 100.

    `live` keeps rows without a readable date under the time of ingestion and falls
    back to the second actor. `backfill` drops such rows, knows the first actor
    only, and makes the date part of the id.
    """
    if mode not in ("live", "backfill"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = (
        # A generator's output is computed once; filters on a plain column of fields
        # would be pushed down with a copy of the splitting for every mention.
        lines.select(F.explode(F.array(_tab_fields(F.col("line")))).alias("f"))
        .filter(F.size("f") >= GDELT_MIN_COLUMNS)
        .select(*[
            _unquoted(F.get("f", F.lit(at))).alias(name) for name, at in GDELT_COLUMNS.items()])
        .withColumn("ts", parse_compact(F.col("date")))
        .withColumn(
            "tone_value", F.coalesce(strip_ws(F.col("tone")).try_cast("double"), F.lit(0.0)))
    )
    actor1, actor2 = (F.nullif(F.col(c), F.lit("")) for c in ("actor1", "actor2"))
    if mode == "live":
        ts = F.coalesce("ts", _ingest_column(ingest_time))
        event_id = make_event_id("gdelt", F.col("id"))
        actor = F.coalesce(actor1, actor2, F.lit("Unknown"))
        payload = F.struct(
            "id", "date", "code", "actor1", "actor2", "country", "tone", "articles")
    else:
        rows = rows.filter(F.col("ts").isNotNull())
        ts = F.col("ts")
        event_id = make_event_id("gdelt", F.col("id"), iso_utc(ts))
        actor = F.coalesce(actor1, F.lit("Unknown"))
        payload = F.struct(F.col("id").alias("raw_id"), F.col("code"))
    return _envelope(
        rows, ingest_time,
        event_id=event_id,
        source=F.lit("gdelt"),
        event_timestamp=ts,
        topic=actor,
        topic_category=cameo_to_category(F.col("code")),
        language=F.lit("en"),
        country_code=F.nullif(F.substring("country", 1, 2), F.lit("")),
        signal_strength=clamp_signal(F.abs("tone_value") / F.lit(100.0)),
        medium_type=F.lit("institutional_media"),
        raw_payload=F.to_json(payload),
    )


def normalise_arxiv(
    entries: DataFrame, mode: str = "feed", max_per_category: int | None = None,
    ingest_time: dt.datetime | None = None, max_authors: int | None = None,
    max_summary: int | None = None,
) -> DataFrame:
    """Papers from feed entries; strength is the number of authors, full at 20.

    `feed` reads RFC-822 dates and keeps the summary; with `max_per_category` it takes
    the first entries of a category in every feed (`feed_date`, in the order of
    `position`). `backfill` shortens ids to the part after `/abs/` and reads ISO dates.
    The payload holds all authors and the whole summary unless a limit is given.
    """
    if mode not in ("feed", "backfill"):
        raise ValueError(f"unknown mode {mode!r}")
    authors = F.greatest(F.coalesce(F.size("authors"), F.lit(0)), F.lit(1))
    listed = F.coalesce("authors", F.array().cast(entries.schema["authors"].dataType))
    if max_authors is not None:
        listed = F.slice(listed, 1, max_authors)
    names = F.transform(listed, lambda a: F.coalesce(a["name"], F.lit("")))
    title = strip_ws(F.coalesce("title", F.lit("")))
    if mode == "feed":
        if max_per_category is not None:
            entries = first_per_group(
                entries, ["category", "feed_date"], [F.col("position"), F.col("id")],
                max_per_category)
        paper_id, ts = F.col("id"), parse_rfc822(F.col("published"))
        summary = F.coalesce("summary", F.lit(""))
        if max_summary is not None:
            summary = F.left(summary, F.lit(max_summary))
        tail = [summary.alias("summary")]
    else:
        title = F.replace(title, F.lit("\n"), F.lit(" "))
        paper_id = F.substring_index("id", "/abs/", -1)
        ts = parse_iso(F.col("published"))
        tail = []
    return _envelope(
        entries.filter((paper_id != "") & (title != "")), ingest_time,
        event_id=make_event_id("arxiv", paper_id),
        source=F.lit("arxiv"),
        event_timestamp=F.coalesce(ts, _ingest_column(ingest_time)),
        topic=title,
        topic_category=arxiv_to_category(F.col("category")),
        language=F.lit("en"),
        country_code=F.lit(None),
        signal_strength=clamp_signal(authors / F.lit(20.0)),
        medium_type=F.lit("formal_knowledge"),
        raw_payload=F.to_json(F.struct(
            paper_id.alias("arxiv_id"), F.col("category"), names.alias("authors"), *tail)),
    )

"""Normalisers and messages on records the derived inputs do not have."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks.inputs import INGEST_TIME
from lumentide.operators.envelope import to_envelope, validate_envelope
from lumentide.operators.normalise import (
    normalise_arxiv, normalise_gdelt, normalise_wiki_changes, normalise_wiki_pageviews,
)
from lumentide.operators.selection import dedupe_events, first_per_group
from lumentide.session import shared_dir
from lumentide.sources import landed


def landed_lines(spark, lines):
    path = shared_dir(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_wiki_changes_from_landed_json(spark):
    path = landed_lines(spark, [json.dumps(r) for r in [
        {"namespace": 0, "bot": False, "title": "Climate", "wiki": "dewiki",
         "timestamp": 1704067200, "revision": {"new": 5}, "length": {"old": 100, "new": 2600},
         "comment": "kept in the payload"},
        {"namespace": 0, "title": "No bot flag", "wiki": "wiki", "timestamp": 0},
        {"namespace": 0, "bot": True, "title": "Robot"},
        {"namespace": 4, "title": "Talk"},
        {"title": "No namespace"},
    ]] + ["{broken"])
    rows = {r["topic"]: r for r in normalise_wiki_changes(
        landed.read_wiki_changes(spark, path), INGEST_TIME).collect()}
    assert set(rows) == {"Climate", "No bot flag"}
    climate = rows["Climate"]
    assert (climate["language"], climate["topic_category"]) == ("de", "environment")
    assert climate["signal_strength"] == 0.25
    assert climate["event_timestamp"] == dt.datetime(2024, 1, 1)
    assert json.loads(climate["raw_payload"])["comment"] == "kept in the payload"
    assert rows["No bot flag"]["language"] == "en"
    assert rows["No bot flag"]["event_timestamp"] == dt.datetime(1970, 1, 1)
    assert rows["No bot flag"]["signal_strength"] == 0.0


def gdelt_line(width=61, **fields):
    at = {"id": 0, "date": 1, "actor1": 6, "actor2": 16, "code": 26, "articles": 33, "tone": 34,
          "country": 37}
    row = [""] * width
    for name, value in fields.items():
        row[at[name]] = value
    return "\t".join(row)


def test_gdelt_modes(spark):
    path = landed_lines(spark, [
        gdelt_line(id="1", date="20240102030405", actor1="A", tone="-150", code="19",
                   country="USA"),
        gdelt_line(id="2", date="20240102", actor2="B", tone="12.5", code="0"),
        gdelt_line(id="3", date="20240102030405", tone="loud"),
        gdelt_line(id="4", date="20240102030405", actor1='"TWO\tPARTS ""Q"""', tone="50"),
        gdelt_line(width=58, id="5", date="20240102030405"),
        gdelt_line(width=57, id="6", date="20240102030405"),
        "",
    ])
    lines = landed.read_gdelt_exports(spark, path)
    live = {json.loads(r["raw_payload"])["id"]: r
            for r in normalise_gdelt(lines, "live", INGEST_TIME).collect()}
    assert set(live) == {"1", "2", "3", "4", "5"}
    assert (live["1"]["signal_strength"], live["1"]["country_code"]) == (1.0, "US")
    assert live["1"]["topic_category"] == "conflict"
    assert (live["2"]["topic"], live["2"]["event_timestamp"]) == ("B", INGEST_TIME)
    assert live["2"]["signal_strength"] == 0.125
    assert (live["3"]["topic"], live["3"]["signal_strength"]) == ("Unknown", 0.0)
    assert live["3"]["country_code"] is None
    assert (live["4"]["topic"], live["4"]["signal_strength"]) == ('TWO\tPARTS "Q"', 0.5)

    history = normalise_gdelt(lines, "backfill", INGEST_TIME)
    kept = {json.loads(r["raw_payload"])["raw_id"]: r for r in history.collect()}
    assert set(kept) == {"1", "3", "4", "5"}
    assert kept["1"]["event_id"] != live["1"]["event_id"]
    with pytest.raises(ValueError):
        normalise_gdelt(lines, "later")


def test_arxiv_modes(spark):
    path = landed_lines(spark, [json.dumps(r) for r in [
        {"id": "http://arxiv.org/abs/2401.1v1", "title": " A\nB ", "category": "q-bio.NC",
         "published": "Tue, 02 Jan 2024 00:00:00 -0500", "summary": "s" * 600,
         "authors": [{"name": f"N{i}"} for i in range(30)], "feed_date": "2024-01-02",
         "position": 0},
        {"id": "x", "title": "  ", "category": "cs.AI", "position": 1},
        {"id": "y", "title": "No authors", "category": "cs.AI", "position": 2, "authors": []},
        {"title": "No id", "category": "cs.AI", "position": 3},
    ]])
    entries = landed.read_arxiv_entries(spark, path)
    feed = {r["topic"]: r for r in normalise_arxiv(entries, "feed", 200, INGEST_TIME).collect()}
    assert set(feed) == {"A\nB", "No authors"}
    paper = feed["A\nB"]
    assert (paper["signal_strength"], paper["topic_category"]) == (1.0, "health")
    assert paper["event_timestamp"] == dt.datetime(2024, 1, 2, 5)
    payload = json.loads(paper["raw_payload"])
    assert (len(payload["authors"]), len(payload["summary"])) == (30, 600)
    assert feed["No authors"]["signal_strength"] == 1 / 20
    assert feed["No authors"]["event_timestamp"] == INGEST_TIME

    history = {r["topic"]: r
               for r in normalise_arxiv(entries, "backfill", ingest_time=INGEST_TIME).collect()}
    assert set(history) == {"A B", "No authors"}
    assert json.loads(history["A B"]["raw_payload"])["arxiv_id"] == "2401.1v1"
    assert history["A B"]["event_timestamp"] == INGEST_TIME   # no ISO date


def test_arxiv_takes_the_first_entries_before_checking_them(spark):
    rows = [(f"p{i}", "" if i < 2 else f"T{i}", None, None, None, "cs.AI", None, i)
            for i in range(6)]
    entries = spark.createDataFrame(
        rows, "id string, title string, published string, authors array<struct<name:string>>, "
              "summary string, category string, feed_date date, position int")
    topics = {r["topic"] for r in normalise_arxiv(entries, "feed", 4, INGEST_TIME).collect()}
    assert topics == {"T2", "T3"}


def test_pageviews_take_the_first_of_each_hour(spark):
    articles = (
        spark.range(3000).select(
            F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 3) * 3600).alias("hour"),
            (F.lit(3000) - F.col("id")).cast("int").alias("rank"),
            F.concat(F.lit("Some_"), "id").alias("article"),
            (F.col("id") * 1000).alias("views"))
        .repartition(8))
    got = normalise_wiki_pageviews(articles, 5, INGEST_TIME)
    assert got.count() == 15
    assert {r["topic"] for r in got.collect()} == {f"Some {i}" for i in range(2985, 3000)}


def test_first_per_group_on_a_hot_group(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        F.pmod(F.hash("id"), F.lit(10**6)).alias("o"), "id").repartition(16)
    order = [F.col("o"), F.col("id")]
    got = {(r["g"], r["id"]) for r in first_per_group(df, ["g"], order, 10, fan_in=4).collect()}
    rows = sorted((r["g"], r["o"], r["id"]) for r in df.collect())
    want, seen = set(), {}
    for g, _, i in rows:
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= 10:
            want.add((g, i))
    assert got == want


def test_dedupe_keeps_the_first_delivery_of_a_hot_id(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds(F.lit(10**9) - F.col("id")).alias("ingested_at"),
        F.col("id").alias("payload")).repartition(16)
    got = dedupe_events(df)
    assert got.count() == 6001
    assert got.filter("event_id = 'hot'").first()["payload"] == 8997


def test_messages_round_trip(spark):
    entry = {"id": "http://arxiv.org/abs/1", "title": "T", "category": "cs.AI", "position": 0,
             "authors": [{"name": "Å"}]}
    events = normalise_arxiv(
        landed.read_arxiv_entries(spark, landed_lines(spark, [json.dumps(entry)])), "backfill",
        ingest_time=INGEST_TIME)
    message = to_envelope(events).first()
    assert (bytes(message["key"]), message["topic"]) == (b"cs.AI", "arxiv_papers")
    value = json.loads(message["value"])
    assert value["raw_payload"]["authors"] == ["Å"]
    assert value["country_code"] is None
    assert value["ingested_at"] == "2024-03-01T12:00:00+00:00"
    checked = validate_envelope(to_envelope(events)).first()
    assert checked["reject_reason"] is None


def test_validation_reasons(spark):
    good = {"event_id": "1", "source": "gdelt", "event_timestamp": "2024-01-01T00:00:00+00:00",
            "topic": "t", "topic_category": "health", "language": "en", "country_code": None,
            "signal_strength": 0.5, "medium_type": "institutional_media"}
    cases = {
        None: good,
        "missing_field": {k: v for k, v in good.items() if k != "country_code"},
        "unexpected_field": good | {"mood": 1},
        "unknown_source": good | {"source": "telegraph"},
        "unknown_topic_category": good | {"topic_category": None},
        "unknown_medium_type": good | {"medium_type": "smoke"},
    }
    rows = [(json.dumps(c).encode(), "t") for c in cases.values()] + [(b"{", "t"), (b"[1]", "t")]
    df = spark.createDataFrame(rows, "value binary, topic string").coalesce(1)
    got = [r["reject_reason"] for r in validate_envelope(df).collect()]
    assert got == [*cases, "malformed", "malformed"]

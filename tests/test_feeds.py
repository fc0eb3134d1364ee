"""Feeds as streams: every message once, the first of each hour, quoted line breaks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import inputs, registry
from lumentide.operators import envelope, normalise
from lumentide.operators.selection import first_per_group
from lumentide.session import shared_dir
from lumentide.sources import landed
from lumentide.streaming import enrich, feeds, source

ORDER = ["rank", "article", "views"]


def test_messages_of_a_feed_are_sent_once_over_restarts(spark, sf_dir):
    path, out, offsets = (shared_dir(spark, p) for p in ("feed", "messages", "offsets"))
    changes = inputs.wiki_changes(spark, sf_dir)
    batches = 0
    for part in range(2):
        changes.filter(F.crc32("title") % 2 == part).repartition(2).write.mode("append").json(path)
        for _again in range(2):  # the second has nothing new
            query = feeds.write_messages(
                feeds.feed_messages(spark, "wiki_changes", path, inputs.INGEST_TIME, max_files=1),
                offsets, path=out, trigger=None)
            query.awaitTermination()
            batches += sum(p["numInputRows"] > 0 for p in query.recentProgress)
    assert batches == 4
    # As after a failure between landing the messages and committing the micro-batch.
    for name in ("3", ".3.crc"):
        os.remove(f"{offsets}/commits/{name}")
    feeds.write_messages(
        feeds.feed_messages(spark, "wiki_changes", path, inputs.INGEST_TIME, max_files=1), offsets,
        path=out, trigger=None).awaitTermination()
    expected = envelope.to_envelope(normalise.normalise_wiki_changes(
        landed.read_wiki_changes(spark, path), inputs.INGEST_TIME))
    got = spark.read.parquet(out).select(*expected.columns)
    assert got.count() == expected.count() > 50
    assert got.exceptAll(expected).isEmpty()
    # And the messages are a stream the enrichment reads.
    lake = shared_dir(spark, "enriched")
    events = enrich.parse_and_enrich(source.read_landed_stream(spark, out), inputs.INGEST_TIME)
    (events.writeStream.format("parquet").option("path", lake)
     .option("checkpointLocation", shared_dir(spark, "offsets")).trigger(availableNow=True)
     .start().awaitTermination())
    assert spark.read.parquet(lake).count() == expected.count()


def test_feeds_without_a_target_or_name(spark):
    with pytest.raises(ValueError, match="path or servers"):
        feeds.write_messages(spark.range(1), "c")
    with pytest.raises(ValueError, match="unknown feed"):
        feeds.feed_messages(spark, "weather", "p")


def lists(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h, m) if h is not None else None, r, a, v) for h, m, r, a, v in rows],
        "hour timestamp, rank int, article string, views long")


def stream(spark, path, out, offsets, n=2):
    query = feeds.start_first_per_hour(
        landed.read_wiki_pageviews(spark, path, stream=True, max_files=1), out, offsets, n,
        [F.col(c) for c in ORDER], trigger=None)
    query.awaitTermination()


def articles(rows):
    return sorted((r["hour"].hour, r["article"]) for r in rows.collect())


def test_first_of_each_hour_over_batches_restarts_and_late_records(spark):
    path, out, offsets = (shared_dir(spark, p) for p in ("feed", "first", "offsets"))
    batches = [
        [(0, 5, 3, "c", 1), (0, 5, 2, "b", 1), (0, 6, 4, "d", 1), (None, 0, 1, "x", 1)],
        [(0, 50, 1, "a", 1), (1, 0, 1, "e", 1)],
        [(2, 0, 1, "f", 1), (0, 59, 2, "a2", 1)],   # hour 0 is still open: 2 is its end plus one
        [(3, 0, 1, "g", 1), (1, 1, 9, "z", 1)],
        [(0, 1, 0, "late", 1), (4, 0, 1, "h", 1)],  # hour 0 has closed
    ]
    like = lists(spark, batches[0])
    seen = []
    for rows in batches:
        lists(spark, rows).coalesce(1).write.mode("append").json(path)
        stream(spark, path, out, offsets)
        seen.append(articles(feeds.read_first_per_hour(spark, out, like)))
    assert seen[:2] == [[], []] and seen[3][:2] == [(0, "a"), (0, "a2")]
    everything = articles(feeds.read_first_per_hour(spark, out, like, closed_only=False))
    assert everything == [(0, "a"), (0, "a2"), (1, "e"), (1, "z"), (2, "f"), (3, "g"), (4, "h")]
    # The last micro-batch once more, as after a failure before it was committed.
    last = max(int(f) for f in os.listdir(f"{offsets}/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{offsets}/commits/{name}")
    stream(spark, path, out, offsets)
    assert articles(feeds.read_first_per_hour(spark, out, like, closed_only=False)) == everything


def test_no_single_task_lands_the_lists(spark, sf_dir, tmp_path, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages.repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    folders, shared = {}, registry.shared_dir

    def kept(spark, purpose):
        folders[purpose] = shared(spark, purpose)
        return folders[purpose]

    monkeypatch.setattr(registry, "shared_dir", kept)
    got = registry.QUERIES["first_per_hour_stream"](spark, str(tmp_path)).collect()
    landings = {f.split("-")[2] for f in os.listdir(folders["feed"]) if f.startswith("part-")}
    files = [f for f in os.listdir(folders["feed"]) if f.startswith("part-")]
    assert len(files) > 2 * len(landings) > 0
    assert sorted(got) == sorted(registry.QUERIES["first_per_hour_stream"](spark, sf_dir).collect())


def test_state_is_bounded_by_open_hours(spark, sf_dir):
    path, out, offsets = (shared_dir(spark, p) for p in ("feed", "first", "offsets"))
    many = spark.range(5000).select(
        F.timestamp_seconds(1704067200 + F.col("id") % 600).alias("hour"),
        F.col("id").cast("int").alias("rank"), F.lit("a").alias("article"), F.col("id").alias("views"))
    many.coalesce(1).write.json(path)
    stream(spark, path, out, offsets, n=7)
    got = feeds.read_first_per_hour(spark, out, many, closed_only=False)
    assert got.count() == 7
    expected = first_per_group(many.withColumn("h", F.date_trunc("hour", "hour")), ["h"],
                               [F.col(c) for c in ORDER], 7).drop("h")
    assert got.exceptAll(expected).isEmpty()


def exports(spark, *texts):
    path = shared_dir(spark, "exports")
    os.makedirs(path)
    for i, text in enumerate(texts):
        with open(f"{path}/{i}.tsv", "w", newline="") as f:
            f.write(text)
    return path


def test_records_end_at_breaks_outside_of_quotes(spark):
    path = exports(
        spark, 'a\tb\tc\n"x\ny"\t"q ""z""\n"\tw\r\n\n5"\t6\nlast\tz"',
        'open\t"never closed\nnext\tline\n', "", '"only\r\none"')
    got = sorted(r["line"] for r in landed.read_gdelt_exports(spark, path, multi_line=True).collect())
    assert got == sorted([
        "a\tb\tc", '"x\ny"\t"q ""z""\n"\tw', '5"\t6', 'last\tz"', 'open\t"never closed',
        "next\tline", '"only\r\none"'])


def test_lines_without_quoted_breaks_are_the_same_either_way(spark, sf_dir):
    path = shared_dir(spark, "exports")
    inputs.gdelt_lines(spark, sf_dir).repartition(3).write.text(path)
    a, b = (landed.read_gdelt_exports(spark, path, multi_line=m) for m in (True, False))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_long_quoted_field_is_one_record(spark):
    path = exports(spark, "k\t\"" + "a b\n" * 200_000 + "\"\tz\n" + "x\ty\n" * 1000)
    got = landed.read_gdelt_exports(spark, path, multi_line=True)
    assert got.count() == 1001 and got.agg(F.max(F.length("line"))).first()[0] > 800_000

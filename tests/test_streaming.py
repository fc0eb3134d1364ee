"""Streams: same rows as the batch, replays, late duplicates."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import inputs
from lumentide.session import shared_dir
from lumentide.sources import tables
from lumentide.streaming import enrich, sinks, source


def test_kafka_options():
    options = source.kafka_options("broker:9092")
    assert options["subscribe"] == "wiki_pageviews,wiki_changes,gdelt_events,arxiv_papers"
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options
    assert source.kafka_options("b", max_offsets=7)["maxOffsetsPerTrigger"] == "7"


def test_malformed_message_becomes_an_all_null_row(spark):
    df = spark.createDataFrame([(b"{oops", "gdelt_events")], "value binary, topic string")
    row = enrich.parse_and_enrich(df, inputs.INGEST_TIME).first().asDict()
    assert row.pop("consciousness_level") == "egocentric"
    assert row.pop("medium_dominance") == "unknown"
    assert row.pop("signal_strength") == 0.0
    assert row.pop("ingested_at") == inputs.INGEST_TIME
    assert set(row.values()) == {None}


def test_stream_equals_batch_over_several_batches(spark, sf_dir):
    landed, out = shared_dir(spark, "messages"), shared_dir(spark, "lake")
    batch = inputs.messages(spark, sf_dir)
    batch.repartition(3).write.parquet(landed)
    events = enrich.parse_and_enrich(
        source.read_landed_stream(spark, landed, max_files=1), inputs.INGEST_TIME)
    query = sinks.write_lake(events, out, shared_dir(spark, "offsets"), trigger=None)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    expected = enrich.parse_and_enrich(batch, inputs.INGEST_TIME)
    got = tables.read_table(spark, out, expected)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def warehouse_stream(spark, sf_dir):
    landed = shared_dir(spark, "messages")
    inputs.messages(spark, sf_dir).repartition(2).write.parquet(landed)
    return enrich.parse_and_enrich(source.read_landed_stream(spark, landed), inputs.INGEST_TIME)


def test_redelivered_batch_is_stored_once(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "warehouse"), shared_dir(spark, "offsets")
    events = warehouse_stream(spark, sf_dir)
    sinks.write_warehouse(events, out, checkpoint, trigger=None).awaitTermination()
    # As after a failure between writing the rows and committing the batch.
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    again = sinks.write_warehouse(events, out, checkpoint, trigger=None)
    again.awaitTermination()
    assert [p["batchId"] for p in again.recentProgress][:1] == [0]
    assert tables.read_table(spark, out, events).count() == 1000


def test_a_stream_started_over_overwrites_nothing(spark, sf_dir):
    out = shared_dir(spark, "warehouse")
    events = warehouse_stream(spark, sf_dir)
    for _ in range(2):
        sinks.write_warehouse(
            events, out, shared_dir(spark, "offsets"), trigger=None).awaitTermination()
    assert tables.read_table(spark, out, events).count() == 2000
    assert tables.read_raw(spark, out).count() == 2000


def test_stream_dedupe_across_batches(spark):
    landed, out = shared_dir(spark, "delivered"), shared_dir(spark, "distinct")
    start = dt.datetime(2024, 1, 1)
    schema = "event_id string, event_timestamp timestamp"
    batches = [
        [("a", start), ("b", start), ("a", start), ("n", None)],
        [("a", start + dt.timedelta(minutes=10)), ("c", start + dt.timedelta(minutes=20)),
         ("m", None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    (enrich.dedupe_stream(events).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", shared_dir(spark, "offsets")).trigger(availableNow=True)
     .start().awaitTermination())
    got = sorted(r["event_id"] for r in spark.read.parquet(out).collect())
    assert got == ["a", "b", "c", "m", "n"]


def test_late_events_pass_the_stream_dedupe(spark):
    landed, out = shared_dir(spark, "delivered"), shared_dir(spark, "distinct")
    start = dt.datetime(2024, 1, 10)
    batches = [[("a", 0)], [("b", -5), ("a", 0)], [("c", 3)], [("d", -9), ("b", -5), ("c", 3)]]
    for rows in batches:
        spark.createDataFrame(
            [(i, start + dt.timedelta(days=d)) for i, d in rows],
            "event_id string, event_timestamp timestamp",
        ).coalesce(1).write.mode("append").parquet(landed)
    events = spark.readStream.schema("event_id string, event_timestamp timestamp").option(
        "maxFilesPerTrigger", 1).parquet(landed)
    query = (enrich.dedupe_stream(events).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", shared_dir(spark, "offsets"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    assert sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect()) == list("abcd")


def test_await_any_reports_a_failed_query(spark, sf_dir):
    landed = shared_dir(spark, "messages")
    inputs.messages(spark, sf_dir).coalesce(1).write.parquet(landed)
    broken = source.read_landed_stream(spark, landed).withColumn(
        "x", F.raise_error(F.lit("broken on purpose")))
    query = (broken.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "o"))
             .trigger(availableNow=True).start())
    with pytest.raises(Exception, match="broken on purpose"):
        sinks.await_any(query)

"""Exact duplicates of a stream: nothing is forgotten, few row groups are read."""

import datetime as dt
import os

from pyspark.sql import functions as F, types as T

from lumentide.session import shared_dir
from lumentide.streaming import seen

SCHEMA = "event_id string, ingested_at timestamp, event_date date"
START = dt.datetime(2024, 1, 1)


def run(spark, path, out, offsets, ids, fan_in=3):
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option(
        "maxFileAge", "36500d").parquet(path)
    query = seen.start_exact_dedupe(events, out, offsets, ids, fan_in=fan_in, trigger=None)
    query.awaitTermination()


def land(spark, path, rows):
    spark.createDataFrame(
        [(i, START + dt.timedelta(days=d), (START + dt.timedelta(days=d)).date()) for i, d in rows],
        SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_copies_weeks_apart_are_dropped_over_restarts_and_merges(spark):
    path, out, offsets, ids = (shared_dir(spark, p) for p in ("in", "out", "offsets", "ids"))
    days = [[("a", 0), ("b", 0), ("a", 0), (None, 0)], [("c", 7), ("a", 7), (None, 7)],
            [("b", 14), ("d", 14)], [("a", 21), ("e", 21)], [("e", 60), ("c", 60), ("f", 60)]]
    for rows in days:
        land(spark, path, rows)
        run(spark, path, out, offsets, ids)
    got = sorted((r["event_id"] or "", r["ingested_at"].day) for r in spark.read.parquet(out).collect())
    assert got == [("", 1), ("", 8), ("a", 1), ("b", 1), ("c", 8), ("d", 15), ("e", 22), ("f", 1)]
    assert len(os.listdir(f"{ids}/level=1")) >= 1  # parts were merged on the way


def test_a_batch_delivered_again_is_not_its_own_copy(spark):
    path, out, offsets, ids = (shared_dir(spark, p) for p in ("in", "out", "offsets", "ids"))
    land(spark, path, [("a", 0), ("b", 0)])
    run(spark, path, out, offsets, ids)
    for name in ("0", ".0.crc"):
        os.remove(f"{offsets}/commits/{name}")
    run(spark, path, out, offsets, ids)
    assert spark.read.parquet(out).count() == 2
    land(spark, path, [("a", 3), ("c", 3)])
    run(spark, path, out, offsets, ids)
    assert sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect()) == ["a", "b", "c"]


def test_a_look_up_reads_few_row_groups(spark):
    ids = seen.SeenIds(spark, shared_dir(spark, "ids"), T.StringType(), fan_in=2)
    hashed = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 18))
    try:
        for part in range(2):
            ids.add(hashed.filter(F.crc32("id") % 2 == part), f"p{part}")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    batch = hashed.limit(3).withColumnRenamed("id", "event_id").unionByName(
        spark.createDataFrame([("unknown",)], "event_id string"))
    found = ids.known(batch, "event_id")
    assert found.count() == 3
    scan = ids.ids().filter(F.col("id").isin([r[0] for r in batch.collect()]))
    scan.collect()
    plan = scan._jdf.queryExecution().executedPlan()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    read = plan.metrics().apply("numOutputRows").value()
    assert 3 <= read < 40_000, read


def test_many_ids_are_joined(spark, monkeypatch):
    monkeypatch.setattr(seen, "MOST_PUSHED", 5)
    ids = seen.SeenIds(spark, shared_dir(spark, "ids"), T.LongType())
    ids.add(spark.range(10), "a")
    ids.add(spark.range(5, 20), "b")
    batch = spark.range(15, 40).withColumnRenamed("id", "event_id")
    assert sorted(r[0] for r in ids.known(batch, "event_id").collect()) == list(range(15, 20))
    assert ids.known(batch, "event_id", but="b").count() == 0


def test_a_large_row_group_is_dealt_to_many_tasks(spark, monkeypatch):
    path, out, offsets, ids = (shared_dir(spark, p) for p in ("in", "out", "offsets", "ids"))
    rows = spark.range(60_000).selectExpr(
        "case when id % 3 > 0 then sha2(cast(id div 6 as string), 256) end as event_id",
        "timestamp_seconds(1704067200 + id) as ingested_at", "date'2024-01-01' as event_date")
    rows.coalesce(1).write.parquet(path)
    shares, dedupe = [], seen.dedupe_events

    def watched(df, *args):
        shares.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return dedupe(df, *args)

    monkeypatch.setattr(seen, "dedupe_events", watched)
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for name in sizes:
        spark.conf.set(name, "64kb")
    try:
        run(spark, path, out, offsets, ids)
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert sum(shares) == 60_000 and max(shares) < 30_000, shares
    assert spark.read.parquet(out).count() == 20_000 + 10_000  # without an id, and distinct ids

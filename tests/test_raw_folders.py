"""Deliveries of many days: how their folders get into the raw table, and how they are listed."""

import pytest
from pyspark.sql import functions as F

from lumentide.schemas import RAW_EVENTS
from lumentide.sources import raw
from lumentide.sources.files import Storage


def days(spark, n, start="2024-01-01"):
    return raw.as_raw_events(spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("event_date")))


def test_many_days_are_listed_by_a_few_tasks(spark, tmp_path):
    n, most = 180, 4 * spark.sparkContext.defaultParallelism
    assert most < n
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    raw.write_batch(days(spark, n), str(tmp_path), "a")
    spark.sparkContext.setJobGroup("listing", "")
    rows = raw.read_raw(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("other", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing")
              for s in tracker.getJobInfo(job).stageIds]
    assert stages and all(tracker.getStageInfo(s).numTasks <= most for s in stages)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert rows.count() == rows.select("event_date").distinct().count() == n


@pytest.mark.parametrize("name", ["plain", "a:b/c=d%e f'[^]{}\\*?#\"\t\x7f"])
def test_a_batch_lies_where_spark_would_write_it(spark, tmp_path, name):
    events = days(spark, 3).union(days(spark, 1).withColumn("event_date", F.lit(None).cast("date")))
    moved, plain = f"{tmp_path}/moved", f"{tmp_path}/plain"
    raw.write_batch(events.withColumn("batch", F.lit("own")), moved, name)
    events.withColumn("batch", F.lit(name)).write.partitionBy("event_date", "batch").parquet(plain)

    def folders(path):
        storage = Storage(spark, path)
        return [(day.name, batch.name) for day in storage.entries(path) if day.name.startswith("event")
                for batch in storage.entries(f"{path}/{day.name}")]

    assert folders(moved) == folders(plain) and len(folders(plain)) == 4
    assert raw.read_raw(spark, moved).columns == RAW_EVENTS.fieldNames()
    assert raw.read_raw(spark, moved).exceptAll(events).isEmpty()


def test_a_delivery_replaces_its_days_only_and_a_failed_one_leaves_nothing(spark, tmp_path):
    path = str(tmp_path)
    raw.write_batch(days(spark, 4), path, "a")
    raw.write_batch(days(spark, 4), path, "b")
    raw.write_batch(days(spark, 2, "2024-01-03").withColumn("topic", F.lit("again")), path, "a")
    with pytest.raises(Exception, match="stopped"):
        raw.write_batch(
            days(spark, 2).withColumn("topic", F.raise_error(F.lit("stopped")).cast("string")), path, "b")
    got = raw.read_raw(spark, path)
    assert got.count() == 8 and got.filter("topic = 'again'").count() == 2
    assert not [e for e in Storage(spark, path).entries(path) if e.name.startswith(raw.DELIVERING)]

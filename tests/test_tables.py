"""Table layout, retention, incremental runs, and the plans behind them."""

import datetime as dt
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import columns, inputs
from lumentide import session
from lumentide.operators import aggregate, dashboard, fact, metrics, normalise
from lumentide.operators.selection import dedupe_events
from lumentide.plans import daily
from lumentide.session import shared_dir
from lumentide.sources import tables, versions
from lumentide.streaming import enrich

AS_OF = dt.date.fromisoformat(inputs.AS_OF)


def raw_table(spark, sf_dir):
    path = shared_dir(spark, "raw")
    return tables.append_backfill(inputs.raw_events(spark, sf_dir), path)


def same(a, b):
    assert a.schema.names == b.schema.names
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_layout_on_disk(spark, sf_dir):
    path = shared_dir(spark, "fact")
    events = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), AS_OF)
    same(tables.materialise(events, path, cluster_by=("source", "topic_category")), events)
    path = versions.current(spark, path)
    days = sorted(d for d in os.listdir(path) if d.startswith("event_date="))
    assert len(days) == 30
    one_day = spark.read.parquet(f"{path}/{days[0]}").select("source").collect()
    assert [r[0] for r in one_day] == sorted(r[0] for r in one_day)


def test_appending_twice_keeps_both(spark, sf_dir):
    path = shared_dir(spark, "raw")
    events = inputs.raw_events(spark, sf_dir)
    tables.append_backfill(events, path)
    assert tables.append_backfill(events, path).count() == 2000


def test_lake_files_lacking_columns(spark):
    lake, raw = shared_dir(spark, "lake"), shared_dir(spark, "raw")
    old = spark.range(3).select(
        F.col("id").cast("string").alias("event_id"), F.lit("gdelt").alias("source"),
        F.lit(0.5).cast("float").alias("signal_strength"),
        F.lit(dt.date(2024, 1, 1)).alias("event_date"))
    old.write.partitionBy("event_date").parquet(lake)
    old.withColumn("topic", F.lit("t")).write.mode("append").partitionBy("event_date").parquet(lake)
    for merge in (False, True):
        got = tables.load_lake_to_raw(
            spark, lake, f"{raw}-{merge}", f"{raw}-{merge}-loaded", merge_schema=merge)
        assert got.count() == 6 and got.filter("topic = 't'").count() == 3
        assert got.schema["signal_strength"].dataType.simpleString() == "double"


def test_expired_partitions_are_dropped(spark, sf_dir):
    path = shared_dir(spark, "raw")
    before = tables.append_backfill(inputs.raw_events(spark, sf_dir), path)
    kept = tables.retain(before, AS_OF, 20)
    expected = kept.count()
    dropped = tables.expire_partitions(spark, path, AS_OF, 20)
    assert dropped[0] == "2024-01-01" and dropped[-1] == "2024-01-20"
    assert tables.read_raw(spark, path).count() == expected


def test_run_daily_and_rebuild_agree(spark, sf_dir):
    raw = raw_table(spark, sf_dir)
    lazy = daily.run_daily(raw, AS_OF)
    root = shared_dir(spark, "warehouse")
    built = daily.rebuild_tables(raw, root, AS_OF)
    for name in ("fact_attention_events", "agg_daily_attention", "synchronicity_score",
                 "shadow_index", "consciousness_level", "mart_dashboard", "quality_checks"):
        layout = {"synchronicity_score": columns.SYNC}.get(name)   # sums differ in the last bits
        a, b = getattr(lazy, name), getattr(built, name)
        same(*(columns.present(x, layout) if layout else x for x in (a, b)))
    assert daily.read_daily(spark, root, "mart_dashboard").count() == lazy.mart_dashboard.count()


def test_refresh_equals_rebuild(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    path, root, whole = (shared_dir(spark, p) for p in ("raw", "warehouse", "whole"))
    first = tables.append_backfill(events.filter("event_date < '2024-01-25'"), path)
    daily.rebuild_tables(first, root, dt.date(2024, 1, 24))
    both = tables.append_backfill(events.filter("event_date >= '2024-01-24'"), path)
    late = dt.date(2024, 1, 24)
    refreshed = daily.refresh_tables(both, root, AS_OF, since=late)
    rebuilt = daily.rebuild_tables(both, whole, AS_OF)
    same(refreshed.fact_attention_events, rebuilt.fact_attention_events)
    same(refreshed.mart_dashboard, rebuilt.mart_dashboard)


def test_refresh_drops_days_beyond_the_window(spark, sf_dir):
    raw = raw_table(spark, sf_dir)
    root = shared_dir(spark, "warehouse")
    daily.rebuild_tables(raw, root, AS_OF)
    later = dt.date(2029, 1, 15)
    run = daily.refresh_tables(raw, root, later, since=dt.date(2024, 1, 20))
    assert run.fact_attention_events.agg(F.min("event_date")).first()[0] == dt.date(2024, 1, 15)


# --- plans ------------------------------------------------------------------

def test_fact_reads_the_raw_table_once_with_pushed_filters(spark, sf_dir, plan):
    text = plan(fact.fact_from_raw(raw_table(spark, sf_dir), AS_OF))
    assert text.count("Location:") == 1
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "In(source" in text and "GreaterThanOrEqual(signal_strength" in text
    assert "Exchange" not in text


def test_generated_code_can_be_compiled(spark, sf_dir):
    """The JVM leaves methods of more than 8,000 bytes of byte code uncompiled."""
    debug = getattr(
        getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for df in (fact.fact_from_raw(raw_table(spark, sf_dir), AS_OF),
               enrich.parse_and_enrich(inputs.messages(spark, sf_dir)),
               normalise.normalise_gdelt(inputs.gdelt_lines(spark, sf_dir)),
               normalise.normalise_wiki_changes(inputs.wiki_changes(spark, sf_dir))):
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        for i in range(stages.size()):
            assert stages.apply(i)._3().maxMethodCodeSize() < 8000


def test_rollup_prunes_columns_and_combines_before_its_only_shuffle(spark, sf_dir, plan):
    text = plan(aggregate.daily_rollup(fact.fact_from_raw(raw_table(spark, sf_dir), AS_OF)))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "language" not in schema and "event_timestamp" not in schema
    assert text.count("hashpartitioning") == 1 and "partial_sum" in text


def test_enrichment_is_native_and_narrow(spark, sf_dir, plan):
    text = plan(enrich.parse_and_enrich(inputs.messages(spark, sf_dir)))
    assert "Python" not in text and "Exchange" not in text


def test_hot_groups_shrink_before_the_shuffle(spark, sf_dir, plan):
    pages = plan(normalise.normalise_wiki_pageviews(inputs.pageviews(spark, sf_dir), top_n=200))
    assert pages.count("WindowGroupLimit") >= 4
    assert "WindowGroupLimit" in plan(dedupe_events(inputs.raw_events(spark, sf_dir)))


def test_dashboards_prune_partitions(spark, sf_dir, plan):
    raw = raw_table(spark, sf_dir)
    events = fact.fact_from_raw(raw, AS_OF)
    scores = tables.materialise(
        metrics.synchronicity_score(aggregate.agg_daily_attention(events)),
        shared_dir(spark, "scores"), "event_date", ("topic_category",))
    for df in (dashboard.dashboard_tile1(events, AS_OF),
               dashboard.recent_kairos_events(scores, AS_OF)):
        assert "PartitionFilters: [isnotnull(event_date" in plan(df)


def test_small_tables_are_few_files(spark, sf_dir):
    root = shared_dir(spark, "warehouse")
    daily.rebuild_tables(raw_table(spark, sf_dir), root, AS_OF)
    mart = versions.current(spark, f"{root}/mart_dashboard")
    files = [f for f in os.listdir(mart) if f.endswith(".parquet")]
    assert len(files) == 1


def test_a_hot_day_is_split_over_tasks(spark):
    """AQE splits one day's rows instead of sending them all to one writer."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = shared_dir(spark, "hot")
        rows = spark.range(0, 200_000, 1, 8).select(
            F.lit(dt.date(2024, 1, 1)).alias("event_date"), F.sha2(F.col("id").cast("string"), 256)
            .alias("topic"), F.lit("gdelt").alias("source"))
        tables.materialise(rows, path, cluster_by=("source",))
        day = f"{versions.current(spark, path)}/event_date=2024-01-01"
        files = [f for f in os.listdir(day) if f.endswith(".parquet")]
        assert len(files) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_levels_need_a_single_grouping(spark, sf_dir, plan):
    text = plan(metrics.consciousness_level_daily(
        fact.fact_from_raw(raw_table(spark, sf_dir), AS_OF)))
    assert text.count("hashpartitioning") == 1 and "Join" not in text


def test_a_load_reads_new_files_only(spark, sf_dir):
    lake, raw, loaded = (shared_dir(spark, p) for p in ("lake", "raw", "loaded"))
    events = inputs.raw_events(spark, sf_dir).withColumn(
        "signal_strength", F.col("signal_strength").cast("float"))
    counts = []
    for days in ("> '2024-01-10'", None, "<= '2024-01-10'"):
        if days:
            events.filter(f"event_date {days}").coalesce(1).write.mode("append") \
                .partitionBy("event_date").parquet(lake)
        query = tables.start_lake_load(spark, lake, raw, loaded)
        query.awaitTermination()
        counts.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert counts[1] == 0 and counts[0] + counts[2] == 1000
    assert tables.read_raw(spark, raw).count() == 1000


def test_compaction_bounds_directories_and_keeps_rows(spark, sf_dir):
    raw = shared_dir(spark, "raw")
    events = inputs.raw_events(spark, sf_dir)
    for part in range(3):
        tables.append_backfill(events.filter(f"event_id % 3 = {part}"), raw)
    before = tables.read_raw(spark, raw)
    expected = before.select("event_id", "event_date", "topic").collect()
    days = tables.compact(spark, raw, dt.date(2024, 1, 20))
    assert days[0] == "2024-01-01" and days[-1] == "2024-01-19"
    assert all(len([b for b in os.listdir(f"{raw}/event_date={d}") if b.startswith("batch=")]) == 1
               for d in days)
    after = tables.read_raw(spark, raw).select("event_id", "event_date", "topic").collect()
    assert sorted(map(str, after)) == sorted(map(str, expected))
    assert tables.compact(spark, raw, dt.date(2024, 1, 20)) == []


def test_a_failed_rebuild_leaves_the_table(spark, sf_dir):
    path = shared_dir(spark, "fact")
    good = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), AS_OF)
    tables.materialise(good, path)
    try:
        tables.materialise(good.withColumn("topic", F.raise_error(F.lit("on purpose"))
                                           .cast("string")), path)
        raise AssertionError("it should have failed")
    except Exception as error:
        assert "on purpose" in str(error)
    same(tables.read_table(spark, path, good), good)


def test_refresh_drops_vanished_days(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    root = shared_dir(spark, "warehouse")
    daily.rebuild_tables(events, root, AS_OF, raw_by_date=False)
    less = events.filter("event_date <> '2024-01-27'")
    refreshed = daily.refresh_tables(
        less, root, AS_OF, since=dt.date(2024, 1, 25), raw_by_date=False)
    same(refreshed.fact_attention_events, fact.fact_from_raw(less, AS_OF))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_no_scratch_on_the_drivers_machine(monkeypatch, master):
    monkeypatch.setattr(session, "_checkpoint_dir", lambda spark: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="shared folder"):
        session.shared_dir(cluster, "x")
    assert session.shared_dir(cluster, "x", "s3://bucket/s/").startswith("s3://bucket/s/x-")
    monkeypatch.setattr(session, "_checkpoint_dir", lambda spark: "hdfs:///shared")
    assert session.shared_dir(cluster, "x").startswith("hdfs:///shared/x-")


def test_rows_without_an_id_all_stay(spark):
    rows = [(None, "a", 1), (None, "b", 1), ("x", "c", 1), ("x", "c", 2)]
    df = spark.createDataFrame(rows, "event_id string, topic string, ingested_at int")
    got = sorted(r["topic"] for r in dedupe_events(df, first_by=("ingested_at",)).collect())
    assert got == ["a", "b", "c"]

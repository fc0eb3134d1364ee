"""Lake, raw table and derived tables over time: expiry, failures, late rows, new columns."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import inputs
from lumentide.operators import fact, quality
from lumentide.plans import daily
from lumentide.session import shared_dir
from lumentide.sources import evolution, lake, raw, tables, versions
from lumentide.sources.files import Storage
from lumentide.streaming import enrich, sinks, source

AS_OF = dt.date.fromisoformat(inputs.AS_OF)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


class Stopped(BaseException):
    pass


@pytest.fixture
def stop_at(monkeypatch):
    """Let the n-th change of the storage (move, remove, write) fail; None lets all pass."""
    state = {"left": None, "done": 0}

    def failing(method):
        real = getattr(Storage, method)

        def call(self, *args):
            if state["left"] == 0:
                raise Stopped(f"{method} {args}")
            if state["left"] is not None:
                state["left"] -= 1
            state["done"] += 1
            return real(self, *args)
        return call

    for method in ("move", "remove", "write"):
        monkeypatch.setattr(Storage, method, failing(method))

    def arm(n):
        state.update(left=n, done=0)
        return state
    return arm


# --- the lake ---------------------------------------------------------------

def days_of(spark, rows):
    return rows.select("event_id", "event_date").orderBy("event_id")


def test_micro_batches_make_few_files_and_no_log(spark, sf_dir):
    landed, out = shared_dir(spark, "messages"), shared_dir(spark, "lake")
    inputs.messages(spark, sf_dir).repartition(16).write.parquet(landed)
    events = enrich.parse_and_enrich(source.read_landed_stream(spark, landed), inputs.INGEST_TIME)
    sinks.write_lake(events, out, shared_dir(spark, "offsets"), trigger=None).awaitTermination()
    assert not os.path.exists(f"{out}/_spark_metadata")
    for day, name in Storage(spark, out).folders(out, "event_date"):
        (batch,) = os.listdir(f"{out}/{name}")
        files = [f for f in os.listdir(f"{out}/{name}/{batch}") if f.endswith(".parquet")]
        assert len(files) <= 2, day


@pytest.mark.parametrize("restart", [False, True])
def test_a_batch_stopped_anywhere_is_delivered_once(spark, stop_at, restart):
    batch = spark.range(40).select(
        F.col("id").alias("event_id"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 4).cast("int"))
        .alias("event_date"))
    at = 0
    while True:
        out = shared_dir(spark, "lake")
        lake.deliver(batch.filter("event_id < 8"), out, "stream", 0)
        state = stop_at(at)
        try:
            lake.deliver(batch.filter("event_id >= 8"), out, "stream", 1)
            finished = True
        except Stopped:
            finished = False
        state["left"] = None
        seen = {f for f in spark.read.parquet(out).inputFiles()}
        if not finished or restart:
            lake.deliver(batch.filter("event_id >= 8"), out, "stream", 1)
        rows = spark.read.parquet(out)
        assert seen <= set(rows.inputFiles())  # what a reader has seen keeps its name
        assert sorted(r[0] for r in rows.select("event_id").collect()) == list(range(40))
        if finished:
            break
        at += 1
    assert at > 5
    assert not [e for e in Storage(spark, out).entries(out) if e.name.startswith(lake.PENDING)]


def test_an_expired_lake_is_read_and_streamed_on(spark, sf_dir):
    landed, out, offsets = (shared_dir(spark, p) for p in ("messages", "lake", "offsets"))
    loaded, table = shared_dir(spark, "loaded"), shared_dir(spark, "raw")
    sent = inputs.messages(spark, sf_dir)

    def stream(part):
        part.write.mode("append").parquet(landed)
        events = enrich.parse_and_enrich(
            source.read_landed_stream(spark, landed), inputs.INGEST_TIME)
        sinks.write_lake(events, out, offsets, trigger=None).awaitTermination()

    stream(sent.filter("topic <> 'gdelt_events'"))
    gone = tables.expire_partitions(spark, out, AS_OF, 20)
    assert gone[0] == "2024-01-01" and gone[-1] == "2024-01-20"
    stream(sent.filter("topic = 'gdelt_events'"))
    expected = enrich.parse_and_enrich(sent, inputs.INGEST_TIME).filter(
        "event_date is null or event_date > '2024-01-20' or source = 'gdelt'")
    assert expected.filter("event_date <= '2024-01-20'").count() > 0
    same(tables.read_table(spark, out, expected), expected)
    got = tables.load_lake_to_raw(spark, out, table, loaded)
    assert got.count() == expected.count()
    assert tables.load_lake_to_raw(spark, out, table, loaded).count() == expected.count()


def test_a_file_sinks_folder_is_refused_until_adopted(spark, sf_dir, stop_at):
    landed = shared_dir(spark, "messages")
    inputs.messages(spark, sf_dir).write.parquet(landed)
    events = enrich.parse_and_enrich(source.read_landed_stream(spark, landed), inputs.INGEST_TIME)
    expected = enrich.parse_and_enrich(inputs.messages(spark, sf_dir), inputs.INGEST_TIME)
    for at in (0, 3, 20):
        out = shared_dir(spark, "sink")
        (events.writeStream.format("parquet").option("path", out).partitionBy("event_date")
         .option("checkpointLocation", shared_dir(spark, "offsets"))
         .trigger(availableNow=True).start().awaitTermination())
        # A file of a failed micro-batch, which the log doesn't list.
        expected.filter("event_date = '2024-01-05'").drop("event_date").coalesce(1).write.mode(
            "append").parquet(f"{out}/event_date=2024-01-05")
        with pytest.raises(ValueError, match="adopt_lake"):
            tables.expire_partitions(spark, out, AS_OF, 20)
        state = stop_at(at)
        with pytest.raises(Stopped):
            lake.adopt_lake(spark, out)
        state["left"] = None
        assert lake.adopt_lake(spark, out) > 0
        same(tables.read_table(spark, out, expected), expected)
        tables.expire_partitions(spark, out, AS_OF, 20)
        same(tables.read_table(spark, out, expected),
             expected.filter("event_date is null or event_date > '2024-01-20'"))
    assert lake.adopt_lake(spark, out) == 0


# --- versions ---------------------------------------------------------------

def test_readers_have_one_whole_version_wherever_a_rebuild_stops(spark, stop_at):
    old = spark.range(100).withColumn("event_date", F.lit(dt.date(2024, 1, 1)))
    new = old.withColumn("id", F.col("id") + 1000)
    at, outcomes = 0, []
    while True:
        path = shared_dir(spark, "table")
        for _ in range(2):  # so that the next rebuild has a version to remove
            tables.materialise(old, path)
        state = stop_at(at)
        try:
            tables.materialise(new, path)
            stopped = False
        except Stopped:
            stopped = True
        state["left"] = None
        first = tables.read_table(spark, path, old).agg(F.min("id"), F.count("*")).first()
        assert tuple(first) in ((0, 100), (1000, 100))
        outcomes.append(first[0])
        tables.materialise(new, path)  # the next run is not disturbed
        same(tables.read_table(spark, path, new), new)
        if not stopped:
            break
        at += 1
    assert outcomes[0] == 0 and outcomes[-1] == 1000 and outcomes == sorted(outcomes)


def test_old_versions_are_removed_later(spark):
    path = shared_dir(spark, "table")
    kept = [tables.materialise(spark.range(n), path, partition_by=None) for n in (1, 2, 3)]
    assert kept[1].count() == 2 and kept[2].count() == 3  # the one before is still read
    assert len([d for d in os.listdir(path) if d.startswith(versions.DATA)]) == 2
    versions.new_version(path)
    _, abandoned = versions.new_version(path)
    spark.range(9).write.parquet(abandoned)
    versions.vacuum(spark, path)
    assert len([d for d in os.listdir(path) if d.startswith(versions.DATA)]) == 2  # still young
    versions.vacuum(spark, path, abandoned_ms=0)
    assert len([d for d in os.listdir(path) if d.startswith(versions.DATA)]) == 1
    assert tables.read_table(spark, path, spark.range(1)).count() == 3


def test_a_table_from_before_versions_is_taken_over(spark):
    path = shared_dir(spark, "table")
    spark.range(5).write.parquet(path)
    assert tables.read_table(spark, path, spark.range(1)).count() == 5
    tables.materialise(spark.range(7), path, partition_by=None)
    assert tables.read_table(spark, path, spark.range(1)).count() == 7
    assert not [f for f in os.listdir(path) if f.endswith(".parquet")]


# --- publication on passed checks -------------------------------------------

def test_a_failing_day_keeps_the_tables_of_the_day_before(spark, sf_dir):
    events, root = inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse")
    day = dt.date.fromisoformat(inputs.QUALITY_DAY)
    good = daily.rebuild_tables(events, root, day, raw_by_date=False, checked=True)
    assert {r["check"]: r["passed"] for r in good.quality_checks.collect()} == dict.fromkeys(
        quality.PASSES, True)
    mart = daily.read_daily(spark, root, "mart_dashboard")
    before = {name: versions.current(spark, f"{root}/{name}") for name in daily.LAYOUT
              if os.path.exists(f"{root}/{name}")}
    with pytest.raises(versions.NotPublished, match="yesterday_rows = 0") as failure:
        daily.rebuild_tables(events, root, AS_OF, raw_by_date=False, checked=True)
    assert "yesterday_rows" in failure.value.failed
    assert before == {name: versions.current(spark, f"{root}/{name}") for name in before}
    same(daily.read_daily(spark, root, "mart_dashboard"), mart)
    for name in before:  # what was written for nothing is gone
        assert len([d for d in os.listdir(f"{root}/{name}") if d.startswith(versions.DATA)]) == 1


def test_observed_checks_equal_measured_ones_without_a_scan(spark, sf_dir, plan):
    events, root = inputs.raw_events(spark, sf_dir), shared_dir(spark, "warehouse")
    day = dt.date.fromisoformat(inputs.QUALITY_DAY)
    run = daily.rebuild_tables(events, root, day, raw_by_date=False, checked=True)
    assert "parquet" not in plan(run.quality_checks).lower()
    same(run.quality_metrics, quality.quality_metrics(run.mart_dashboard, day).select(
        *[F.col(c).cast("bigint") for c in quality.PASSES]))


# --- days that changed ------------------------------------------------------

def test_rows_weeks_late_are_picked_up_and_only_their_days_rebuilt(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    path, root, whole = (shared_dir(spark, p) for p in ("raw", "warehouse", "whole"))
    late = "source = 'gdelt' and event_date in ('2024-01-03', '2024-01-09')"
    tables.append_backfill(events.filter(f"event_date < '2024-01-25' and not ({late})"), path)
    daily.refresh_changed(spark, path, root, AS_OF)
    fact_path = versions.current(spark, f"{root}/fact_attention_events")
    first = {d: os.listdir(f"{fact_path}/{d}") for d in os.listdir(fact_path) if "=" in d}
    tables.append_backfill(events.filter("event_date >= '2024-01-25'"), path)
    tables.append_backfill(events.filter(late), path)
    run = daily.refresh_changed(spark, path, root, AS_OF)
    rebuilt = daily.rebuild_tables(tables.read_raw(spark, path), whole, AS_OF)
    same(run.fact_attention_events, rebuilt.fact_attention_events)
    same(run.mart_dashboard, rebuilt.mart_dashboard)
    after = {d: os.listdir(f"{fact_path}/{d}") for d in os.listdir(fact_path) if "=" in d}
    touched = {d for d in after if after[d] != first.get(d)}
    assert {"event_date=2024-01-03", "event_date=2024-01-09"} <= touched
    assert "event_date=2024-01-04" not in touched and len(after) == 30
    assert daily.refresh_changed(spark, path, root, AS_OF).fact_attention_events.count() == \
        rebuilt.fact_attention_events.count()


def test_days_stay_noted_until_a_refresh_is_done(spark, sf_dir, monkeypatch):
    events = inputs.raw_events(spark, sf_dir)
    path, root = shared_dir(spark, "raw"), shared_dir(spark, "warehouse")
    tables.append_backfill(events.filter("event_date <> '2024-01-03'"), path)
    daily.refresh_changed(spark, path, root, AS_OF)
    tables.append_backfill(events.filter("event_date = '2024-01-03'"), path)
    real = daily.replace_partitions
    monkeypatch.setattr(daily, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        daily.refresh_changed(spark, path, root, AS_OF)
    monkeypatch.setattr(daily, "replace_partitions", real)
    run = daily.refresh_changed(spark, path, root, AS_OF)
    same(run.fact_attention_events, fact.fact_from_raw(events, AS_OF))


def test_compacted_days_are_not_lost_to_the_refresh(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    path, root = shared_dir(spark, "raw"), shared_dir(spark, "warehouse")
    tables.append_backfill(events.filter("source <> 'gdelt'"), path)
    daily.refresh_changed(spark, path, root, AS_OF)
    tables.append_backfill(events.filter("source = 'gdelt'"), path)
    tables.compact(spark, path, dt.date(2024, 1, 20))  # merges batches no run has seen
    run = daily.refresh_changed(spark, path, root, AS_OF)
    same(run.fact_attention_events, fact.fact_from_raw(events, AS_OF))


# --- compaction -------------------------------------------------------------

def delivered(spark, path):
    """Three batches, one with columns the raw table doesn't know."""
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("event_id"), F.lit("gdelt").alias("source"),
        F.lit("science").alias("topic_category"), F.lit(0.5).alias("signal_strength"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("event_date"))
    for part in range(3):
        some = rows.filter(f"event_id % 3 <> {part} or true").filter(f"event_id div 10 = {part}")
        some = some.withColumn("consciousness_level", F.lit("integral")) if part == 1 else some
        tables.write_batch(some, path, f"b{part}")
    return [(str(i), "integral" if 10 <= i < 20 else None) for i in range(30)]


def found(rows):
    return sorted(((r["event_id"], r["consciousness_level"]) for r in rows.collect()),
                  key=lambda r: int(r[0]))


def test_a_compaction_stopped_anywhere_leaves_every_row_once(spark, stop_at):
    at = 0
    while True:
        path = shared_dir(spark, "raw")
        expected = delivered(spark, path)
        state = stop_at(at)
        try:
            tables.compact(spark, path, dt.date(2024, 2, 1))
            stopped = False
        except Stopped:
            stopped = True
        state["left"] = None
        assert found(tables.read_raw(spark, path)) == expected, at
        tables.compact(spark, path, dt.date(2024, 2, 1))
        assert found(tables.read_raw(spark, path)) == expected, at
        storage = Storage(spark, path)
        for day, name in storage.folders(path, "event_date"):
            assert len(list(storage.folders(f"{path}/{name}", "batch"))) == 1
        assert not storage.entries(f"{path}/{raw.INTENTS}")
        assert not [e for e in storage.entries(path) if e.name.startswith(raw.ASIDE)]
        if not stopped:
            break
        at += 1
    assert at > 10


def test_compaction_keeps_columns_nobody_recorded(spark):
    path = shared_dir(spark, "raw")
    delivered(spark, path)
    foreign = spark.createDataFrame(
        [("x", 7, dt.date(2024, 1, 1))], "event_id string, views int, event_date date")
    foreign.withColumn("batch", F.lit("foreign")).write.mode("append").partitionBy(
        "event_date", "batch").parquet(path)
    assert "views" not in tables.read_raw(spark, path).columns
    tables.compact(spark, path, dt.date(2024, 2, 1))
    (row,) = tables.read_raw(spark, path).filter("event_id = 'x'").collect()
    assert row["views"] == 7


# --- schemas ----------------------------------------------------------------

def test_columns_are_added_and_types_widened(spark):
    lake_path, path, loaded = (shared_dir(spark, p) for p in ("lake", "raw", "loaded"))
    day = F.lit(dt.date(2024, 1, 1)).alias("event_date")

    def land(*columns):
        spark.range(2).select(*columns, day).write.mode("append").partitionBy(
            "event_date").parquet(lake_path)

    land(F.lit("a").alias("event_id"), F.lit(0.5).cast("float").alias("signal_strength"))
    tables.load_lake_to_raw(spark, lake_path, path, loaded, merge_schema=True)
    land(F.lit("b").alias("event_id"), F.lit(3).alias("views"),
         F.lit(1.5).cast("decimal(4,2)").alias("price"))
    land(F.lit("c").alias("event_id"), F.lit(1 << 40).alias("views"), F.lit("eu").alias("region"),
         F.lit(2.125).cast("decimal(8,3)").alias("price"))
    got = tables.load_lake_to_raw(spark, lake_path, path, loaded, merge_schema=True)
    kinds = dict(got.dtypes)
    assert (kinds["views"], kinds["region"], kinds["price"], kinds["signal_strength"]) == (
        "bigint", "string", "decimal(8,3)", "double")
    rows = {(r["event_id"], r["signal_strength"], r["views"], r["region"], r["price"] and float(r["price"]))
            for r in got.collect()}
    assert got.count() == 6 and rows == {
        ("a", 0.5, None, None, None), ("b", None, 3, None, 1.5), ("c", None, 1 << 40, "eu", 2.125)}
    # A later load without merging keeps what the table has.
    land(F.lit("d").alias("event_id"))
    later = tables.load_lake_to_raw(spark, lake_path, path, loaded)
    assert later.count() == 8 and later.filter("region = 'eu'").count() == 2


def test_incompatible_types_name_the_column(spark):
    path = shared_dir(spark, "raw")
    a = spark.createDataFrame(
        [(1, "gdelt", "science", dt.date(2024, 1, 1))],
        "views int, source string, topic_category string, event_date date")
    tables.write_batch(a, path, "a")
    with pytest.raises(evolution.IncompatibleSchemas, match="views is int and string"):
        tables.write_batch(a.withColumn("views", F.lit("many")), path, "b")


def test_a_record_taken_by_another_writer_is_merged(spark, monkeypatch):
    path = shared_dir(spark, "raw")
    schema = lambda c: spark.createDataFrame([], f"{c} int").schema
    evolution.record_schema(spark, path, schema("a"))
    real, first = Storage.write, []

    def write(self, name, text):
        if not first:
            first.append(name)
            evolution.record_schema(spark, path, schema("b"))
        return real(self, name, text)

    monkeypatch.setattr(Storage, "write", write)
    evolution.record_schema(spark, path, schema("c"))
    assert evolution.recorded_schema(spark, path).fieldNames() == ["a", "b", "c"]

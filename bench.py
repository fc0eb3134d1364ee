"""Times the headline queries and prints one JSON line.

Every query is run once to warm up and then five times; the median counts. Results
go to Spark's noop sink, so that all rows and columns are computed and none leave
the executors. `growth` repeats some on many copies of the events, once each.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_TIMES (copies).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from checks import inputs  # noqa: E402
from checks.inputs import AS_OF, INGEST_TIME  # noqa: E402
from lumentide.operators import aggregate, dashboard, fact, metrics, normalise  # noqa: E402
from lumentide.operators.selection import dedupe_events  # noqa: E402
from lumentide.plans.daily import rebuild_tables, run_daily  # noqa: E402
from lumentide.session import build_session, shared_dir  # noqa: E402
from lumentide.sources import landed, tables  # noqa: E402
from lumentide.streaming import enrich, sinks, source  # noqa: E402


COPIES = 20


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def prepare(spark: SparkSession, sf_dir: str) -> dict:
    """The inputs as they would lie in storage: tables, messages, landed files.

    Messages come 20 times over, so that throughput is more than start-up time.
    """
    at = {name: shared_dir(spark, name) for name in ("raw", "messages", "exports", "warehouse")}
    raw = tables.append_backfill(inputs.raw_events(spark, sf_dir), at["raw"])
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    (inputs.messages(spark, sf_dir).withColumn("copy", copies).drop("copy")
     .repartition(16).write.parquet(at["messages"]))
    inputs.gdelt_lines(spark, sf_dir).repartition(8).write.text(at["exports"])
    return {
        "raw": raw,
        "run": rebuild_tables(raw, at["warehouse"], AS_OF),
        "messages": spark.read.schema(source.MESSAGE).parquet(at["messages"]),
        "stream": source.read_landed_stream(spark, at["messages"]),
        "exports": landed.read_gdelt_exports(spark, at["exports"]),
    }


def workloads(spark: SparkSession, sf_dir: str) -> dict:
    """Each table from the stored tables before it, then the whole runs and the stream."""
    data = prepare(spark, sf_dir)
    raw, run = data["raw"], data["run"]
    events, agg = run.fact_attention_events, run.agg_daily_attention

    def tile2():
        return dashboard.dashboard_tile2(
            run.synchronicity_score, run.shadow_index, run.consciousness_level, agg, AS_OF)

    def streamed():
        sinks.write_lake(
            enrich.parse_and_enrich(data["stream"]), shared_dir(spark, "lake"),
            shared_dir(spark, "offsets"), trigger=None).awaitTermination()

    return {
        "fact_attention_events": lambda: consume(fact.fact_from_raw(raw, AS_OF)),
        "agg_daily_attention": lambda: consume(aggregate.agg_daily_attention(events)),
        "synchronicity_score": lambda: consume(metrics.synchronicity_score(agg)),
        "shadow_index": lambda: consume(metrics.shadow_index(agg)),
        "consciousness_level": lambda: consume(metrics.consciousness_level_daily(events)),
        "dashboard_tile1": lambda: consume(dashboard.dashboard_tile1(events, AS_OF)),
        "dashboard_tile2": lambda: consume(tile2()),
        "mart_dashboard": lambda: consume(dashboard.mart_dashboard(
            dashboard.dashboard_tile1(events, AS_OF), tile2())),
        "run_daily": lambda: consume(run_daily(raw, AS_OF).mart_dashboard),
        "rebuild_tables": lambda: consume(
            rebuild_tables(raw, shared_dir(spark, "warehouse"), AS_OF).mart_dashboard),
        "normalise_gdelt": lambda: consume(
            normalise.normalise_gdelt(data["exports"], "live", INGEST_TIME)),
        "dedupe_events": lambda: consume(dedupe_events(raw)),
        "parse_and_enrich": lambda: consume(enrich.parse_and_enrich(data["messages"])),
        "parse_and_enrich_stream": streamed,
    }


def growth(spark: SparkSession, sf_dir: str, times: int) -> dict:
    """Rows per second on the events as given and on `times` copies with other ids and dates."""
    found: dict[str, dict[str, int]] = {}
    for n in (1, times):
        copy = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy")
        back = (F.col("copy") % 20 * 31).cast("int")
        many = inputs.raw_events(spark, sf_dir).select("*", copy).withColumns({
            "event_id": F.concat_ws("-", "event_id", F.col("copy").cast("string")),
            "event_date": F.date_sub("event_date", back),
            "event_timestamp": F.col("event_timestamp") - F.make_dt_interval(days=back),
        }).drop("copy")
        raw = tables.append_backfill(many, shared_dir(spark, "raw"))
        exports = shared_dir(spark, "exports")
        inputs.gdelt_lines(spark, sf_dir).select("*", copy).select(
            F.concat("copy", "line").alias("line")).write.text(exports)
        events = fact.fact_from_raw(raw, AS_OF)
        work = {
            "fact_from_raw": lambda: consume(events),
            "daily_rollup": lambda: consume(aggregate.daily_rollup(events)),
            "dedupe_events": lambda: consume(dedupe_events(raw)),
            "normalise_gdelt": lambda: consume(normalise.normalise_gdelt(
                landed.read_gdelt_exports(spark, exports), "live", INGEST_TIME)),
            "rebuild_tables": lambda: rebuild_tables(
                raw, shared_dir(spark, "warehouse"), AS_OF),
        }
        rows = raw.count()
        for name, run in work.items():
            if n == 1:
                run()
            start = time.perf_counter()
            run()
            found.setdefault(name, {})[f"rows_per_sec_{n}x"] = round(
                rows / (time.perf_counter() - start))
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, work in workloads(spark, sf_dir).items():
        work()
        runs = []
        for _ in range(5):
            start = time.perf_counter()
            work()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    rows = COPIES * inputs.table(spark, sf_dir, "events").count()
    print(json.dumps({
        "metric": "sum of median seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {
            "enrichment_native": round(rows / seconds["parse_and_enrich"]),
            "enrichment_stream": round(rows / seconds["parse_and_enrich_stream"]),
        },
        "growth": growth(spark, sf_dir, int(os.environ.get("BENCH_TIMES", "100"))),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""The daily run: raw events to checked dashboard mart.

The raw table is read once. Everything after the fact table is derived from its
daily rollup, whose size follows the number of days, so that of all steps only the
rollup (and the fact table, where it is wanted as a table) touches the events.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumentide.operators.aggregate import (
    agg_daily_attention, daily_noospheric_density, daily_rollup,
)
from lumentide.operators.dashboard import (
    dashboard_tile1, dashboard_tile2, mart_dashboard, recent_kairos_events, tile1_chart,
    tile2_series,
)
from lumentide.operators.fact import fact_from_raw
from lumentide.operators.metrics import (
    consciousness_level_daily, shadow_index, source_signals, synchronicity_score,
)
from lumentide.operators.quality import assert_quality, mart_checks, quality_metrics
from lumentide.operators.staging import staging_start, stg_arxiv, stg_gdelt, stg_wikipedia
from lumentide.session import pin
from lumentide.sources.files import Storage
from lumentide.sources.landed import ALL_AGES
from lumentide.sources.raw import read_raw
from lumentide.sources.tables import (
    Version, drop_partitions, read_table, replace_partitions, write_version,
)
from lumentide.sources.versions import POINTERS, Checked, current

# Partition column and clustering of the tables. The tables above the rollup have a
# few rows per day: as one directory per day they would be thousands of tiny files,
# so they are sorted by date instead and skipped through by row group.
LAYOUT: Mapping[str, tuple[str | None, tuple[str, ...]]] = {
    "stg_wikipedia": ("event_date", ("source", "topic_category")),
    "stg_gdelt": ("event_date", ("topic_category",)),
    "stg_arxiv": ("event_date", ("topic_category",)),
    "fact_attention_events": ("event_date", ("source", "topic_category")),
    "daily_rollup": ("event_date", ("topic_category", "source")),
    "agg_daily_attention": (None, ("event_date", "topic_category", "source")),
    "synchronicity_score": (None, ("event_date", "topic_category")),
    "shadow_index": (None, ("event_date", "topic_category")),
    "consciousness_level": (None, ("event_date",)),
    "mart_dashboard": (None, ("event_date", "topic_category")),
}

#: Tables read straight from the raw table, in its partitions.
BY_DATE = ("stg_wikipedia", "stg_gdelt", "stg_arxiv", "fact_attention_events")


@dataclass(frozen=True)
class DailyRun:
    """Tables of a run, what is shown of them, and the outcome of its checks."""

    stg_wikipedia: DataFrame
    stg_gdelt: DataFrame
    stg_arxiv: DataFrame
    fact_attention_events: DataFrame
    agg_daily_attention: DataFrame
    daily_noospheric_density: DataFrame
    synchronicity_score: DataFrame
    shadow_index: DataFrame
    consciousness_level: DataFrame
    mart_dashboard: DataFrame
    tile1_chart: DataFrame
    tile2_series: DataFrame
    recent_kairos_events: DataFrame
    quality_metrics: DataFrame
    quality_checks: DataFrame


def _build(
    raw: DataFrame, as_of: dt.date | str | None, keep: Callable[[str, DataFrame], DataFrame],
    staging: bool = False, checks: Checked | None = None,
) -> DailyRun:
    # The fact table comes from one pass over the raw table; the staging tables are for
    # those who want them and cost nothing until read.
    staged = {"stg_wikipedia": stg_wikipedia(raw, as_of), "stg_gdelt": stg_gdelt(raw, as_of),
              "stg_arxiv": stg_arxiv(raw, as_of)}
    if staging:
        staged = {name: keep(name, df) for name, df in staged.items()}
    fact = keep("fact_attention_events", fact_from_raw(raw, as_of))
    rollup = keep("daily_rollup", daily_rollup(fact))
    agg = keep("agg_daily_attention", agg_daily_attention(rollup))
    signals = source_signals(agg)
    sync = keep("synchronicity_score", synchronicity_score(signals))
    shadow = keep("shadow_index", shadow_index(signals))
    level = keep("consciousness_level", consciousness_level_daily(rollup))
    mart = keep("mart_dashboard", mart_dashboard(
        dashboard_tile1(rollup, as_of), dashboard_tile2(sync, shadow, level, agg, as_of)))
    if checks:  # observed while the mart was written, which is not read again
        metrics = mart.sparkSession.createDataFrame(
            [tuple(checks.observed()[name] for name in checks.passes)],
            ", ".join(f"{name} bigint" for name in checks.passes))
    else:
        metrics = quality_metrics(mart, as_of)
    return DailyRun(
        **staged, fact_attention_events=fact, agg_daily_attention=agg,
        daily_noospheric_density=daily_noospheric_density(agg), synchronicity_score=sync,
        shadow_index=shadow, consciousness_level=level, mart_dashboard=mart,
        tile1_chart=tile1_chart(mart), tile2_series=tile2_series(mart),
        recent_kairos_events=recent_kairos_events(sync, as_of), quality_metrics=metrics,
        quality_checks=assert_quality(metrics))


def run_daily(
    raw: DataFrame, as_of: dt.date | str | None = None, scratch: str | None = None,
) -> DailyRun:
    """All tables as DataFrames. Runs one job, for the rollup; the rest stays lazy.

    The rollup is kept below `scratch`, shared storage that the caller may remove when
    done with the run; by default below the cluster's checkpoint folder.
    """
    return _build(raw, as_of, lambda name, df: (
        pin(df, name, scratch) if name == "daily_rollup" else df))


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


class _Writer:
    """Writes the tables of a run and publishes them together at its end.

    With checks on the mart nothing is published when they fail.
    """

    def __init__(self, root: str, as_of: dt.date | str | None, raw_by_date: bool, checked: bool):
        self.root, self.raw_by_date = root, raw_by_date
        self.checks = mart_checks(as_of) if checked else None
        self.versions: list[Version] = []

    def write(self, name: str, df: DataFrame) -> DataFrame:
        version = write_version(
            df, _path(self.root, name), *LAYOUT[name],
            in_place=self.raw_by_date and name in BY_DATE,
            checks=self.checks if name == "mart_dashboard" else None)
        self.versions.append(version)
        return version.rows

    def run(
        self, raw: DataFrame, as_of: dt.date | str | None,
        keep: Callable[[str, DataFrame], DataFrame], staging: bool = False,
    ) -> DailyRun:
        try:
            run = _build(raw, as_of, keep, staging, self.checks)
        except BaseException:
            for version in self.versions:
                version.drop()
            raise
        for version in self.versions:
            version.publish()
        return run


def rebuild_tables(
    raw: DataFrame, root: str, as_of: dt.date | str | None = None, raw_by_date: bool = True,
    staging: bool = False, checked: bool = False,
) -> DailyRun:
    """All tables written below `root`, each in full and from the ones before.

    They are published when all are complete, so readers have the old run's tables or the new
    one's. With `checked` that also takes the checks on the mart, observed as it is written:
    where one fails, NotPublished is raised and all tables stay as they were.

    With `staging` the three staging tables are written too, at a pass each.

    The fact table needs no shuffle when the raw table it is read from is
    partitioned by date, as it should be; pass `raw_by_date=False` otherwise.
    """
    writer = _Writer(root, as_of, raw_by_date, checked)
    return writer.run(raw, as_of, writer.write, staging)


def refresh_tables(
    raw: DataFrame, root: str, as_of: dt.date, since: dt.date | None = None,
    raw_by_date: bool = True, days: Collection[dt.date] | None = None, checked: bool = False,
) -> DailyRun:
    """Bring the tables of an earlier run up to date, reading some days' raw events.

    A day of the fact table and of the rollup depends on that day's events alone, so
    only the days from `since` on are rebuilt, or those in `days`; `refresh_changed` finds out
    which have changed. What lies beyond the staging window is dropped. The small tables are
    rebuilt in full from the whole rollup, and days that have no rows any more disappear. The
    result equals a full rebuild as long as no other day has changed.

    The small tables are published together when complete and, with `checked`, sound. Fact
    and rollup are replaced by partitions; after a failure refresh the same days again.
    """
    if (since is None) == (days is None):
        raise ValueError("give since or days")
    spark = raw.sparkSession
    date = F.col("event_date")
    chosen = date >= F.lit(since) if days is None else date.isin(sorted(days))
    of_run = (lambda day: day >= since) if days is None else (lambda day: day in days)
    present = {r[0] for r in (  # a scan of one column of the refreshed days
        fact_from_raw(raw, as_of).filter(chosen).select("event_date").distinct().collect())}
    writer = _Writer(root, as_of, raw_by_date, checked)

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name not in ("fact_attention_events", "daily_rollup"):
            return writer.write(name, df)
        path = _path(root, name)
        kept = replace_partitions(
            df.filter(chosen), path, *LAYOUT[name],
            in_place=raw_by_date and name == "fact_attention_events")
        oldest = staging_start(as_of)
        drop_partitions(
            spark, path, lambda day: day < oldest or of_run(day) and day not in present)
        return read_table(spark, path, kept)

    return writer.run(raw, as_of, keep)


CHANGES = "_changed_days"


def note_changed_days(spark: SparkSession, raw_path: str, root: str) -> None:
    """Note the days of raw files that arrived since the last call, beside the tables.

    The raw table is read as a file stream of its partition values: the checkpoint
    knows the files seen so far, whichever batch delivered them, and no row of them is read.
    Days are noted before the checkpoint moves on, and stay noted until a refresh is done.
    """
    storage, folder = Storage(spark, root), _path(root, CHANGES)
    files = (
        spark.readStream.schema("event_date date, batch string")
        .option("maxFileAge", ALL_AGES).parquet(raw_path))

    def note(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        days = [r[0].isoformat() for r in batch.select("event_date").distinct().collect() if r[0]]
        name = f"{folder}/days/{query}-{batch_id}"
        storage.remove(name)
        storage.write(name, json.dumps(sorted(days)))

    (files.writeStream.option("checkpointLocation", f"{folder}/seen").foreachBatch(note)
     .trigger(availableNow=True).start().awaitTermination())


def refresh_changed(
    spark: SparkSession, raw_path: str, root: str, as_of: dt.date, checked: bool = False,
) -> DailyRun:
    """Bring the tables up to date with all deliveries since the last run, however late.

    The days to rebuild follow from the raw files that arrived since then (see
    `note_changed_days`); rows for a day weeks back rebuild that day alone. The first
    run rebuilds everything. A run that fails leaves its days noted for the next one, so the
    result always equals a full rebuild. `as_of` must not go back between runs.
    """
    note_changed_days(spark, raw_path, root)
    storage, folder = Storage(spark, root), f"{_path(root, CHANGES)}/days"
    notes = [e.name for e in storage.entries(folder) if not e.name.startswith(".")]
    raw = read_raw(spark, raw_path)
    if not storage.exists(f"{_path(root, 'daily_rollup')}/{POINTERS}"):
        run = rebuild_tables(raw, root, as_of, checked=checked)
    else:
        days = {dt.date.fromisoformat(day) for name in notes
                for day in json.loads(storage.read(f"{folder}/{name}"))}
        run = refresh_tables(raw, root, as_of, days=days, checked=checked)
    for name in notes:
        storage.remove(f"{folder}/{name}")
    return run


def read_daily(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table written by `rebuild_tables`."""
    if name not in LAYOUT:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(current(spark, _path(root, name)))

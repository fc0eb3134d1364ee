"""Partitioned Parquet tables: layout, rebuild, retention.

Rows are brought together by partition value with a REBALANCE hint. AQE then
splits a partition that is too large, such as a day holding a third of the table,
and merges small ones, so that no single task writes a whole day. The raw event table is
in `raw`, and its functions can be called here, too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumentide.functions import as_date
from lumentide.schemas import RAW_CLUSTERING, RETENTION_DAYS
from lumentide.sources.files import Storage
from lumentide.sources.layout import laid_out
from lumentide.sources.raw import (  # noqa: F401
    append_backfill, as_raw_events, compact, load_lake_to_raw, read_raw, start_lake_load,
    write_batch,
)
from lumentide.sources.versions import (
    Checked, NotPublished, current, new_version, publish,
)


def _write(
    df: DataFrame, path: str, mode: str, partition_by: str | None = "event_date",
    cluster_by: Sequence[str] = RAW_CLUSTERING, in_place: bool = False, overwrite: str = "static",
) -> None:
    writer = laid_out(df, partition_by, cluster_by, in_place).write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", overwrite).partitionBy(partition_by)
    writer.parquet(path)


@dataclass(frozen=True)
class Version:
    """A version of a table that is written but not published yet."""

    path: str
    name: str
    folder: str
    rows: DataFrame

    def publish(self) -> None:
        publish(self.rows.sparkSession, self.path, self.name)

    def drop(self) -> None:
        Storage(self.rows.sparkSession, self.path).remove(self.folder)


def write_version(
    df: DataFrame, path: str, partition_by: str | None = "event_date",
    cluster_by: Sequence[str] = (), in_place: bool = False, checks: Checked | None = None,
) -> Version:
    """Write a version of a table beside the present one; `publish` switches to it.

    With `checks` a version that fails them, as observed while it was written, is dropped
    and NotPublished is raised.
    """
    spark = df.sparkSession
    name, folder = new_version(path)
    _write(checks.on(df) if checks else df, folder, "overwrite", partition_by, cluster_by, in_place)
    rows = spark.read.schema(df.schema).parquet(folder).select(*df.columns)
    version = Version(path, name, folder, rows)
    if checks and checks.failed():
        version.drop()
        raise NotPublished(path, checks.observed(), checks.failed())
    return version


def materialise(
    df: DataFrame, path: str, partition_by: str | None = "event_date",
    cluster_by: Sequence[str] = (), in_place: bool = False, checks: Checked | None = None,
) -> DataFrame:
    """Rebuild a derived table in full and return it as read back.

    The new version is written beside the old one and published by one small file (see
    `versions`): whatever step a run fails at, readers have the old table or the new one. The
    version before stays until the next rebuild, for readers that have begun with it.
    """
    version = write_version(df, path, partition_by, cluster_by, in_place, checks)
    version.publish()
    return version.rows


def replace_partitions(
    df: DataFrame, path: str, partition_by: str = "event_date", cluster_by: Sequence[str] = (),
    in_place: bool = False,
) -> DataFrame:
    """Rebuild only the partitions `df` has rows for and return the whole table.

    In place, in the present version. Spark moves the new partitions in one after the other
    when all are written; after a failure in between, run it again.
    """
    spark = df.sparkSession
    folder = current(spark, path)
    _write(df, folder, "overwrite", partition_by, cluster_by, in_place, "dynamic")
    return read_table(spark, path, df)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table's present version with the columns of `like`, without schema inference."""
    return spark.read.schema(like.schema).parquet(current(spark, path)).select(*like.columns)


def retain(
    df: DataFrame, as_of: dt.date | str | None = None, days: int = RETENTION_DAYS,
) -> DataFrame:
    """Rows young enough to keep; prunes partitions when read from a table."""
    return df.filter(F.col("event_date") >= F.date_sub(as_date(as_of), days))


def expire_partitions(
    spark: SparkSession, path: str, as_of: dt.date, days: int = RETENTION_DAYS,
) -> list[str]:
    """Drop the table's partitions older than the retention and name them."""
    return drop_partitions_before(spark, path, as_of - dt.timedelta(days=days))


def drop_partitions_before(spark: SparkSession, path: str, oldest: dt.date) -> list[str]:
    """Drop the partitions of days before `oldest` and name them."""
    return drop_partitions(spark, path, lambda day: day < oldest)


def drop_partitions(
    spark: SparkSession, path: str, gone: Callable[[dt.date], bool],
) -> list[str]:
    """Drop the partitions of the days that are `gone` and name them.

    A metadata operation: it deletes directories and reads or rewrites no rows. A folder
    whose files are listed in a file sink's log is refused: the log would list them still
    and every later read would fail. `adopt_lake` makes such a folder an ordinary one.
    """
    folder = current(spark, path)
    storage = Storage(spark, folder)
    if storage.exists(f"{folder}/_spark_metadata"):
        raise ValueError(f"{folder} has a file sink's log; adopt_lake() it first")
    dropped = []
    for day, name in storage.folders(folder, "event_date"):
        if gone(dt.date.fromisoformat(day)) and storage.remove(f"{folder}/{name}"):
            dropped.append(day)
    return sorted(dropped)

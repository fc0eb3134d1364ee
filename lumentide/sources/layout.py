"""How rows are dealt to the tasks that write a table, and how its folders are named and listed."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: What Spark doesn't put into a folder's name as it is.
_ESCAPED = re.compile(r"[\x01-\x1F\x7F\"#%'*/:=?\\{\[\]^]")


def laid_out(
    df: DataFrame, partition_by: str | None = "event_date", cluster_by: Sequence[str] = (),
    in_place: bool = False,
) -> DataFrame:
    """Rows balanced over tasks by partition value and sorted for row-group skipping.

    Without a partition column the rows are merely balanced and sorted.

    `in_place` leaves rows in the tasks they are in. That saves the shuffle where
    the input is read from a table partitioned the same way, so that a task sees
    few partition values as it is.
    """
    keys = [partition_by] if partition_by else []
    placed = df if in_place else df.hint("rebalance", *map(F.col, keys))
    order = [*keys, *cluster_by]
    return placed.sortWithinPartitions(*order) if order else placed


def partition_folder(key: str, value: str) -> str:
    """The folder Spark writes a partition value to."""
    shown = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", value)
    return f"{key}={shown or '__HIVE_DEFAULT_PARTITION__'}"


def read_folders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of many folders; a few tasks a core list them, not one for each folder."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(_LISTING, before)

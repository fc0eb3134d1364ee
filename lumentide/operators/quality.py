"""Checks on the finished mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lumentide.functions import as_date
from lumentide.sources.versions import Checked


class QualityError(RuntimeError):
    """A check on the mart failed."""


def quality_metrics(mart: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """One row: yesterday's rows, scores above 1, categories seen in the last week."""
    day = as_date(as_of)
    week = mart.filter(F.col("event_date") >= F.date_sub(day, 7))
    return week.agg(
        F.count_if(F.col("event_date") == F.date_sub(day, 1)).alias("yesterday_rows"),
        F.count_if((F.col("total_signal") > 1.0) & (F.col("tile_type") == "temporal"))
        .alias("invalid_sync_scores"),
        F.count_distinct("topic_category").alias("active_categories"),
    )


#: When a measure will do; for columns as well as for values.
PASSES = {
    "yesterday_rows": lambda found: found > 0,
    "invalid_sync_scores": lambda found: found == 0,
    "active_categories": lambda found: found >= 4,
}


def assert_quality(metrics: DataFrame) -> DataFrame:
    """One row per check: what was found and whether it will do."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("check"), passes(F.col(name)).alias("passed"),
                 F.col(name).alias("actual"))
        for name, passes in PASSES.items()])
    return metrics.select(F.inline(rows))


def mart_checks(as_of: dt.date | str | None = None) -> Checked:
    """The same checks, observed while the mart is written.

    Observed aggregates cannot be distinct counts; a set of the categories, a handful, is
    what they count.
    """
    day = as_date(as_of)
    week = F.col("event_date") >= F.date_sub(day, 7)
    return Checked({
        "yesterday_rows": F.count_if(F.col("event_date") == F.date_sub(day, 1)),
        "invalid_sync_scores": F.count_if(
            week & (F.col("total_signal") > 1.0) & (F.col("tile_type") == "temporal")),
        "active_categories": F.size(F.collect_set(F.when(week, F.col("topic_category")))).cast("bigint"),
    }, PASSES)


def raise_on_failure(checks: DataFrame) -> None:
    """Stop the run when a check failed. There are three checks, so this collects three rows."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError(", ".join(f"{row['check']} = {row['actual']}" for row in failed))

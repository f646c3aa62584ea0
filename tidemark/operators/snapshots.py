"""Selections from a metrics history.

A history holds snapshots: all rows that share one snapshot_time. The bounds below are uncorrelated
scalar subqueries, so each runs once, reads the time column only, and reaches the Parquet scan as a filter.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = "snapshot_time"


def high_water_mark(history: DataFrame, column: str = TIME) -> DataFrame:
    """One row: the newest time, null for an empty table."""
    return history.agg(F.max(column).alias("max_time"))


def latest_time(history: DataFrame) -> Column:
    return high_water_mark(history).scalar()


def previous_time(history: DataFrame) -> Column:
    """The second newest distinct time; null if there is none."""
    return high_water_mark(history.where(F.col(TIME) < latest_time(history))).scalar()


def previous_or_latest_time(history: DataFrame) -> Column:
    """Where the two newest snapshots begin; the only one counts as both."""
    before = F.when(F.col(TIME) < latest_time(history), F.col(TIME))
    return history.agg(F.coalesce(F.max(before), F.max(TIME)).alias("bound")).scalar()


def latest_snapshot(history: DataFrame) -> DataFrame:
    return history.where(F.col(TIME) == latest_time(history))


def previous_snapshot(history: DataFrame) -> DataFrame:
    return history.where(F.col(TIME) == previous_time(history))


def newer_than(history: DataFrame, mark: datetime | str | None, column: str = TIME) -> DataFrame:
    """Rows strictly newer than a mark; all rows if there is no mark, as for an empty target."""
    if mark is None:
        return history
    return history.where(F.col(column) > F.lit(mark).cast("timestamp"))

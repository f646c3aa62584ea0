"""Time differences."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_instant(moment: datetime | str | Column | None) -> Column:
    """A given moment, or the query's start when none is given."""
    if moment is None:
        return F.current_timestamp()
    if isinstance(moment, Column):
        return moment
    return F.lit(moment).cast("timestamp")


def age_minutes(since: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(since)) / F.lit(60_000_000.0)


def utc(micros: int | None) -> datetime | None:
    """Microseconds since 1970 as a time with zone; values taken from Spark without one can be ambiguous."""
    return None if micros is None else datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=micros)

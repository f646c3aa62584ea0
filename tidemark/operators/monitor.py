"""Freshness and size of the history tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import STALE_AFTER_MINUTES
from tidemark.functions.timing import age_minutes, as_instant
from tidemark.operators.snapshots import TIME


def table_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: number of rows and newest snapshot."""
    rows = [
        table.agg(F.count("*").alias("n_rows"), F.max(TIME).alias("latest_snapshot")).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def freshness(
    report: DataFrame,
    as_of: datetime | str | Column | None = None,
    stale_after: float = STALE_AFTER_MINUTES,
) -> DataFrame:
    """Per table of a report: newest snapshot, its age and EMPTY, STALE (older than the limit) or OK."""
    age = F.col("age_minutes")
    aged = report.select(
        "table_name",
        "latest_snapshot",
        age_minutes(F.col("latest_snapshot"), as_instant(as_of)).alias("age_minutes"),
    )
    return aged.withColumn(
        "status", F.when(age.isNull(), "EMPTY").when(age > stale_after, "STALE").otherwise("OK")
    )


class UnhealthyTable(RuntimeError):
    pass


def assert_fresh(checked: DataFrame, tables: list[str]) -> None:
    """Raises for the first of the tables, in the given order, that is empty or stale.

    ``checked`` is what ``freshness`` gives: one row per table.
    """
    found = {row["table_name"]: row for row in checked.collect()}
    for name in tables:
        row = found[name]
        if row["status"] == "EMPTY":
            raise UnhealthyTable(f"{name}: no snapshot was ever written")
        if row["status"] == "STALE":
            raise UnhealthyTable(
                f"{name}: the newest snapshot, of {row['latest_snapshot']}, is {row['age_minutes']:.2f} minutes old"
            )

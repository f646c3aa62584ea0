"""Cumulative metrics per dimension value."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import as_instant


def metrics(silver: DataFrame, dimension: str) -> DataFrame:
    """Count, sum and average of the amounts per value; null is a value of its own.

    The scan reads two columns. Partial aggregation leaves one row per value and task for the shuffle,
    however unevenly the rows are spread over the values.
    """
    return silver.groupBy(dimension).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
    )


def metrics_by(silver: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """``metrics`` of several dimensions from one reading: a row per dimension and value, named in columns."""
    values = [F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]
    each = silver.select("amount", F.inline(F.array(*values)))
    return each.groupBy("dimension", "value").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
    )


def advance(
    before: DataFrame, changed: DataFrame, dimension: str, n: int | None, snapshot_time: datetime | str
) -> DataFrame:
    """The snapshot after ``before``, of which ``changed`` has the new metrics of the values that changed.

    Counts only grow. So each of the n most frequent values is one of the n before, or one of the n most frequent of
    those that changed, and of a value in both the greater count is the new one. No more than 2 n rows are shuffled.
    """
    measures = ["transaction_count", "total_amount", "avg_amount"]
    own = changed.where(F.col("dimension") == dimension).select(F.col("value").alias(dimension), *measures)
    if n is not None:
        own = top_n(own, dimension, n)
    both = before.select(dimension, *measures).unionByName(own)
    newest = both.groupBy(dimension).agg(F.max_by(F.struct(*measures), "transaction_count").alias("m"))
    rows = newest.select(dimension, "m.*")
    if n is not None:
        rows = top_n(rows, dimension, n)
    # One file makes a snapshot whole: a commit moves files one by one, and a reader between two of them would take the time
    # of half a snapshot as its mark.
    return stamp(rows.repartition(1), snapshot_time)


def by_count(dimension: str) -> list[Column]:
    """Most frequent first, ties by name, so that a cut at any rank is well defined."""
    return [F.col("transaction_count").desc(), F.col(dimension).asc_nulls_last()]


def top_n(measured: DataFrame, dimension: str, n: int) -> DataFrame:
    """The n most frequent values: a top-k per task and one merge, not a global sort."""
    return measured.orderBy(*by_count(dimension)).limit(n)


def stamp(measured: DataFrame, snapshot_time: datetime | str | Column | None = None) -> DataFrame:
    """One time for all rows of a snapshot; the start of the query (or micro-batch) if none is given."""
    return measured.withColumn("snapshot_time", as_instant(snapshot_time))


def snapshot(
    silver: DataFrame,
    dimension: str,
    n: int | None = None,
    snapshot_time: datetime | str | Column | None = None,
) -> DataFrame:
    """The metrics of everything in silver, cut to the n most frequent values if asked."""
    measured = metrics(silver, dimension)
    if n is not None:
        measured = top_n(measured, dimension, n)
    return stamp(measured, snapshot_time)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))

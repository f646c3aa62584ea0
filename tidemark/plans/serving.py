"""Metrics histories, the ledger and its alerts to the serving database."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import ALERTS_TABLE, DIMENSIONS, HISTORY_TABLES, TRANSACTIONS_TABLE, JdbcTarget, Paths
from tidemark.functions.timing import utc
from tidemark.operators import ledger
from tidemark.operators.snapshots import TIME, newer_than
from tidemark.sinks import jdbc_append
from tidemark.sources import batch_table, jdbc_summary
from tidemark.streaming.ledger import create_ledger

log = logging.getLogger("tidemark.serving")

ROWS_PER_TRANSACTION = 1_000_000
CREATED = "created_at"


@dataclass(frozen=True)
class SyncResult:
    table: str
    mark: datetime | None
    rows: int
    error: str | None = None
    # Rows without a time that were left out, since nothing tells whether the target has them.
    untimed: int = 0


@dataclass(frozen=True)
class Load:
    """What to append, in this order, and the rows without a time that are left out."""

    parts: list[DataFrame]
    rows: int
    untimed: int


def sync(
    spark: SparkSession,
    history: DataFrame,
    target: JdbcTarget,
    table: str,
    column: str = TIME,
    rows_per_transaction: int = ROWS_PER_TRANSACTION,
) -> SyncResult:
    """Appends the snapshots newer than the target's newest; everything if the target is empty."""
    state = jdbc_summary(spark, target, table, column).select(
        F.col("n_rows").cast("bigint").alias("n"), F.unix_micros("latest_snapshot").alias("micros")
    ).first()
    mark = utc(state["micros"])
    load = pending(history, mark, column, rows_per_transaction, with_untimed=not state["n"])
    for part in load.parts:
        jdbc_append(part, target, table)
    if load.untimed:
        log.warning("%s: %s rows have no %s and were left out", table, load.untimed, column)
    return SyncResult(table, mark, load.rows, untimed=load.untimed)


def backfill(
    spark: SparkSession,
    history: DataFrame,
    target: JdbcTarget,
    table: str,
    column: str = TIME,
    rows_per_transaction: int = ROWS_PER_TRANSACTION,
) -> SyncResult:
    """Loads a whole history, creating the table if there is none.

    On a table that already holds snapshots it continues after the newest, so a second run, or one
    after a failure, adds no row twice.
    """
    jdbc_append(history.limit(0), target, table)
    return sync(spark, history, target, table, column, rows_per_transaction)


def sync_all(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    target: JdbcTarget,
    load=sync,
) -> list[SyncResult]:
    """One pass over several tables; a failing table does not keep the others from loading.

    A table's time is its snapshot time, or when its rows were made: all rows of one trigger share it.
    """
    results = []
    for table, rows in tables.items():
        column = TIME if TIME in rows.columns else CREATED
        try:
            results.append(load(spark, rows, target, table, column))
        except Exception as error:  # noqa: BLE001 - reported per table
            log.exception("sync of %s failed", table)
            results.append(SyncResult(table, None, 0, str(error)))
    return results


def histories(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """The metrics histories by the name of their serving table."""
    return {
        HISTORY_TABLES[dimension]: batch_table(spark, paths.history(dimension), schemas.gold(dimension))
        for dimension in DIMENSIONS
    }


def payments(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """The ledger's transactions and the fraud alerts by the name of their serving table."""
    create_ledger(spark, paths)
    return {
        TRANSACTIONS_TABLE: ledger.transactions(batch_table(spark, paths.ledger, schemas.LEDGER)),
        ALERTS_TABLE: batch_table(spark, paths.alerts, schemas.FRAUD_ALERTS),
    }


def table_report(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    """``monitor.table_report`` of the serving tables, with one row fetched from each."""
    rows = [
        jdbc_summary(spark, target, table).select(
            F.lit(table).alias("table_name"), F.col("n_rows").cast("bigint").alias("n_rows"), "latest_snapshot"
        )
        for table in HISTORY_TABLES.values()
    ]
    return reduce(DataFrame.unionByName, rows)


def pending(
    history: DataFrame,
    mark: datetime | str | None,
    column: str = TIME,
    rows_per_transaction: int = ROWS_PER_TRANSACTION,
    with_untimed: bool = False,
) -> Load:
    """What a target whose newest time is ``mark`` lacks, in ascending order of time, cut into whole snapshots.

    Usually there are a few rows and one part. If a load stops early, the target's newest snapshot is
    the last part's, and everything up to it is there, so the next run continues behind it. Rows without a
    time come first, with the oldest snapshots, if an empty target is to have them too.
    """
    new = newer_than(history, mark, column)
    time, timed = F.col(column), F.count(column)
    size = new.agg(F.count("*").alias("rows"), timed.alias("timed")).first()
    untimed = size["rows"] - size["timed"]
    if mark is not None:
        untimed = history.where(time.isNull()).count()
    bounds = _slice_bounds(new, column, size["timed"], rows_per_transaction) if size["timed"] else []
    parts = []
    for lower, upper in zip([None, *bounds], bounds):
        part = time <= upper
        if lower is not None:
            part &= time > lower
        elif with_untimed:
            part |= time.isNull()
        parts.append(new.where(part))
    if with_untimed and untimed and not parts:
        parts.append(new.where(time.isNull()))
    if with_untimed:
        return Load(parts, size["rows"], 0)
    return Load(parts, size["timed"], untimed)


def _slice_bounds(new: DataFrame, column: str, rows: int, rows_per_transaction: int) -> list[datetime]:
    """Ascending times that cut the rows into slices of about the given size; the last is the newest."""
    slices = max(1, -(-rows // rows_per_transaction))
    fractions = [(i + 1) / slices for i in range(slices)]
    cuts = new.agg(
        F.max(F.unix_micros(column)).alias("newest"),
        F.percentile_approx(F.unix_micros(column), fractions, 10 * slices).alias("cuts"),
    ).first()
    return [utc(micros) for micros in sorted({*cuts["cuts"], cuts["newest"]})]

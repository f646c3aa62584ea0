"""Tables of the serving database."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JdbcTarget
from tidemark.functions.timing import utc


def jdbc_table(spark: SparkSession, target: JdbcTarget, table: str) -> DataFrame:
    return spark.read.jdbc(target.url, table, properties=target.properties)


def quoted(target: JdbcTarget, name: str) -> str:
    """A name as it is written; MySQL's databases take double quotes for text unless told otherwise."""
    mark = "`" if target.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
    return f"{mark}{name}{mark}"


def jdbc_high_water_mark(
    spark: SparkSession, target: JdbcTarget, table: str, column: str = "snapshot_time"
) -> datetime | None:
    """The newest time in a table."""
    newest = jdbc_summary(spark, target, table, column)
    return utc(newest.select(F.unix_micros("latest_snapshot").alias("micros")).first()["micros"])


def jdbc_summary(
    spark: SparkSession, target: JdbcTarget, table: str, column: str = "snapshot_time"
) -> DataFrame:
    """One row: number of rows and newest time, found by the database.

    Aggregates over ``read.jdbc`` would fetch the whole column instead.
    """
    n, latest, time = (quoted(target, c) for c in ("n_rows", "latest_snapshot", column))
    query = f"SELECT COUNT(*) AS {n}, MAX({time}) AS {latest} FROM {table}"
    return jdbc_table(spark, target, f"({query}) summary")


def jdbc_recent(
    spark: SparkSession, target: JdbcTarget, table: str, column: str = "snapshot_time"
) -> DataFrame:
    """The rows of the two newest snapshots, chosen by the database."""
    time = quoted(target, column)
    newest = f"SELECT MAX({time}) FROM {table}"
    before = f"{newest} WHERE {time} < ({newest})"
    query = f"SELECT * FROM {table} WHERE {time} >= COALESCE(({before}), ({newest}))"
    return jdbc_table(spark, target, f"({query}) recent")


def jdbc_trend(
    spark: SparkSession, target: JdbcTarget, table: str, measure: str, where: dict[str, str] | None = None
) -> DataFrame:
    """``snapshot_time`` and the sum of a measure per snapshot, grouped and filtered by the database.

    ``where`` holds plain values that columns must have; they are not escaped and must not come from users.
    """
    time, name = quoted(target, "snapshot_time"), quoted(target, measure)
    tests = " AND ".join(f"{quoted(target, c)} = '{v}'" for c, v in (where or {}).items())
    condition = f" WHERE {tests}" if tests else ""
    return jdbc_table(
        spark, target, f"(SELECT {time}, SUM({name}) AS {name} FROM {table}{condition} GROUP BY {time}) trend"
    )

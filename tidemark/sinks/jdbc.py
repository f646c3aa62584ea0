"""Writes to the serving database."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import JdbcTarget


def jdbc_append(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Appends in one transaction: Spark commits per partition, and there is one.

    The rows pass through a single task, so callers bound them (``plans.serving`` does). The shuffle leaves
    what makes the rows, such as a scan of many files, to as many tasks as it needs.
    """
    df.repartition(1).write.jdbc(target.url, table, mode="append", properties=target.properties)


@contextmanager
def connection(spark: SparkSession, target: JdbcTarget, transaction: bool = False) -> Iterator:
    """A connection of the driver's, for statements that the database runs by itself.

    With ``transaction``, what is done takes effect as a whole at the end, or not at all if there is an error.
    """
    jvm = spark._jvm
    if target.driver:
        # As Spark does, so that drivers that come as packages are found.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(target.driver)
    account = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in target.properties:
            account.setProperty(name, target.properties[name])
    found = jvm.java.sql.DriverManager.getConnection(target.url, account)
    try:
        found.setAutoCommit(not transaction)
        yield found
        if transaction:
            found.commit()
    except BaseException:
        if transaction:
            found.rollback()
        raise
    finally:
        found.close()


def execute(database, statement: str, *values) -> int:
    """Runs a statement: the first value of what it finds, or the number of rows that it changes."""
    prepared = database.prepareStatement(statement)
    try:
        for place, value in enumerate(values, 1):
            if isinstance(value, int):
                prepared.setLong(place, value)
            else:
                prepared.setString(place, value)
        if not prepared.execute():
            return prepared.getUpdateCount()
        found = prepared.getResultSet()
        return found.getLong(1) if found.next() else 0
    finally:
        prepared.close()


def table_exists(spark: SparkSession, target: JdbcTarget, table: str) -> bool:
    with connection(spark, target) as database:
        names = database.getMetaData()
        schema, _, name = table.rpartition(".")
        # Names are kept as they are, or in the case that the database gives to names without quotes.
        for change in (str, str.upper, str.lower):
            found = names.getTables(None, change(schema) or None, change(name), None)
            if found.next():
                return True
    return False

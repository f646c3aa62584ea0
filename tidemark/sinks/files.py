"""Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark import journal, layout
from tidemark.layout import NO_STREAM, batch_path


def write_batch(df: DataFrame, path: str, stream: str, batch: int) -> str:
    """Writes one micro-batch to a directory of its own, so that a replay replaces itself, and tells the table's readers.

    The stream's id is part of the path: a query with a new checkpoint counts its batches from zero
    again, under a new id, and overwrites nothing.
    """
    target = batch_path(path, stream, batch)
    df.write.mode("overwrite").parquet(target)
    journal.publish(df.sparkSession, path, stream, batch)
    return target


def append_batch(df: DataFrame, path: str, stream: str = "loads") -> str:
    """Adds a batch to a table from outside a streaming query. A stream has one writer at a time."""
    spark = df.sparkSession
    numbers = [f.number for f in layout.folds(spark, path) if f.stream == stream]
    batches = layout.values(spark, layout.fold_path(path, stream, max(numbers)), "batch") if numbers else []
    return write_batch(df, path, stream, max((int(b) + 1 for b in batches), default=0))


def create_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Makes a batch-by-batch table readable before its first batch; leaves an existing one alone."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(batch_path(path, NO_STREAM, -1))

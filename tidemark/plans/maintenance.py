"""Upkeep of tables that are written batch by batch."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidemark import layout


def compact(spark: SparkSession, path: str, schema: StructType) -> int:
    """Merges the folds of a table that get no more batches; gives their number.

    Streams and readers may run meanwhile. The newest fold of each stream is left alone: a restarted stream may
    repeat and replace its newest batch. A merge that was interrupted is not complete and is done again.
    """
    closed = [f for f in layout.folds(spark, path) if not f.newest and not f.merged]
    for fold in closed:
        batches = spark.read.schema(schema).parquet(layout.fold_path(path, fold.stream, fold.number))
        rows = batches.select(schema.fieldNames()).hint("rebalance")
        rows.write.mode("overwrite").parquet(layout.merged_path(path, fold.stream, fold.number))
    return len(closed)

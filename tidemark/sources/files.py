"""Parquet tables, as batch scans and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark import layout, schemas


def parquet_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A full scan with the declared schema: no footer is read to plan it.

    A directory written by a streaming sink is read through the sink's log of committed files.
    """
    return spark.read.schema(schema).parquet(path)


def batch_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    besides: tuple[str, int] | None = None,
    besides_stream: str | None = None,
) -> DataFrame | None:
    """A table written batch by batch (``sinks.write_batch``), its directory levels removed.

    Batches of merged folds are read from the merged folders, and their own folders are not even listed.
    ``besides`` leaves out one (stream, batch), of a fold still open; this prunes a directory and reads nothing of it.
    ``besides_stream`` leaves out all of a stream; None is the result if no other one has written.
    """
    found = layout.folds(spark, path)
    if besides_stream is not None:
        found = [f for f in found if f.stream not in (besides_stream, layout.NO_STREAM)]
        if not found:
            return None
    open_folds = [layout.fold_path(path, f.stream, f.number) for f in found if not f.merged]
    merged = [layout.merged_path(path, f.stream, f.number) for f in found if f.merged]
    reader = spark.read.schema(schemas.extend(schema, schemas.BATCH_LEVELS)).option("basePath", path)
    if not open_folds and merged:
        return spark.read.schema(schema).parquet(*merged)
    table = reader.parquet(*(open_folds or [path]))
    if besides is not None:
        stream, batch = besides
        table = table.where(~((table["stream"] == stream) & (table["batch"] == batch)))
    table = table.select(schema.fieldNames())
    return table.unionAll(spark.read.schema(schema).parquet(*merged)) if merged else table


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """New files of a Parquet directory. Either limit, not both, bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)

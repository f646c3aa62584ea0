"""Streams into tables of batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sinks import create_table, write_batch
from tidemark.streaming.identity import query_id


def append_stream(
    df: DataFrame,
    path: str,
    schema: StructType,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    of: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Streaming append to a table of batches: a trigger costs what it writes, and no log of all files is kept.

    ``of`` makes the table's rows from a micro-batch, where ``df`` does not have them itself.
    """
    create_table(df.sparkSession, path, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if of is None else of(batch)
        write_batch(rows.select(schema.fieldNames()), path, query_id(batch), batch_id)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()

"""Which streaming query a micro-batch belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame


def query_id(batch: DataFrame) -> str:
    """The id kept in the query's checkpoint: equal after a restart, new with a new checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if found is None:
        raise RuntimeError("not inside a streaming query")
    return found

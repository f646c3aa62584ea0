"""Messages to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.config import Paths
from tidemark.operators.bronze import to_bronze
from tidemark.streaming.append import append_stream


def bronze_stream(messages: DataFrame, paths: Paths, trigger: dict | None = None) -> StreamingQuery:
    """``messages`` has the message source's schema, usually ``sources.kafka_stream``."""
    return append_stream(
        to_bronze(messages), paths.bronze, schemas.BRONZE, paths.checkpoint("bronze_batches"), trigger, "bronze"
    )

"""Bronze to silver: stateless, without a shuffle."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import journal, schemas
from tidemark.config import Paths, Thresholds
from tidemark.operators.silver import rejects, to_silver
from tidemark.streaming.append import append_stream


def silver_stream(
    spark: SparkSession,
    paths: Paths,
    trigger: dict | None = None,
    thresholds: Thresholds = Thresholds(),
    max_batches: int | None = None,
) -> StreamingQuery:
    """One batch of silver per trigger with new batches of bronze. ``rejects_stream`` keeps the messages that give no row."""
    return append_stream(
        journal.entries(spark, paths.bronze, "silver", max_batches),
        paths.silver,
        schemas.SILVER,
        paths.checkpoint("silver_batches"),
        trigger,
        "silver",
        lambda batch: to_silver(journal.taken(spark, batch, schemas.BRONZE), thresholds),
    )


def rejects_stream(
    spark: SparkSession, paths: Paths, trigger: dict | None = None, max_batches: int | None = None
) -> StreamingQuery:
    """The messages that silver leaves out, with the reason: a reader of bronze of its own, so silver does not wait for it."""
    return append_stream(
        journal.entries(spark, paths.bronze, "rejects", max_batches),
        paths.rejects,
        schemas.REJECTS,
        paths.checkpoint("rejects"),
        trigger,
        "rejects",
        lambda batch: rejects(journal.taken(spark, batch, schemas.BRONZE)),
    )

"""Messages to the ledger of transactions and its fraud alerts.

De-duplication is exact and reaches back to the first row ever written. The stream keeps the first arrival of every id
as state on the executors' disks, so a trigger costs what its own messages cost, however large the ledger is. What
other streams have written, such as one with an earlier checkpoint, is compared by scanning those streams' ids.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.config import FraudRules, Paths
from tidemark.operators import ledger
from tidemark.operators.ledger import ARRIVAL_ORDER
from tidemark.session import settings, state_store
from tidemark.sinks import create_table, write_batch
from tidemark.sources import batch_table, parquet_table
from tidemark.streaming.identity import query_id

log = logging.getLogger("tidemark.streaming")

# A batch whose ids fit in this much memory per executor is compared with the ledger by broadcast.
BROADCAST_BYTES = 128 * 1024 * 1024


def create_ledger(spark: SparkSession, paths: Paths) -> None:
    create_table(spark, paths.ledger, schemas.LEDGER)
    create_table(spark, paths.alerts, schemas.FRAUD_ALERTS)


def write_ledger_batch(
    batch: DataFrame,
    batch_id: int,
    stream: str,
    paths: Paths,
    order: Sequence[str | Column] = ARRIVAL_ORDER,
    rules: FraudRules = FraudRules(),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Adds a batch of parsed messages without streaming state: it is compared with the whole ledger.

    A replay after a failure at any point adds nothing twice.

    The first arrivals are written out before they are compared with the ledger: the work on the batch
    is done once, is safe from lost executors, and its size is known when Spark plans the comparison.
    Alerts are read from the ledger rows just written, so a crash in between loses none.
    """
    arrivals = ledger.entries(ledger.score(ledger.first_arrivals(batch, order), rules), F.col("created_at"))
    existing = batch_table(batch.sparkSession, paths.ledger, schemas.LEDGER, besides=(stream, batch_id))
    _add(arrivals, existing, batch_id, stream, paths, broadcast_bytes)


def write_first_seen(
    batch: DataFrame,
    batch_id: int,
    stream: str,
    paths: Paths,
    rules: FraudRules = FraudRules(),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Adds the new ids of one micro-batch of ``operators.ledger.first_seen``. A replay repeats and replaces it."""
    new = batch.where(F.col("created_at") == F.col("updated_at"))
    arrivals = ledger.entries(ledger.score(new, rules), F.col("created_at"))
    existing = batch_table(batch.sparkSession, paths.ledger, schemas.LEDGER, besides_stream=stream)
    _add(arrivals, existing, batch_id, stream, paths, broadcast_bytes)


def _add(
    arrivals: DataFrame, existing: DataFrame | None, batch_id: int, stream: str, paths: Paths, broadcast_bytes: int
) -> None:
    spark = arrivals.sparkSession
    added = arrivals
    if existing is not None:
        staging = f"{paths.ledger_staging}/stream={stream}"
        arrivals.write.mode("overwrite").parquet(staging)
        staged = parquet_table(spark, staging, schemas.LEDGER)
        # Ids found in the ledger are some of the staged ones, so one check bounds both.
        small = ledger.key_bytes(staged).first()["bytes"] <= broadcast_bytes
        found = ledger.matching_keys(existing, staged, broadcast=small)
        added = ledger.not_in(staged, found, broadcast=small)
    # Counted while the rows are written.
    counts = Observation()
    added = added.observe(counts, F.count(F.lit(1)).alias("entries"), F.count_if("is_fraud").alias("alerts"))
    written = write_batch(added.select(schemas.LEDGER.fieldNames()), paths.ledger, stream, batch_id)
    log.info("ledger batch %s: %s entries, %s alerts", batch_id, counts.get["entries"], counts.get["alerts"])

    rows = parquet_table(spark, written, schemas.LEDGER)
    write_batch(ledger.fraud_alerts(rows), paths.alerts, stream, batch_id)


def ledger_stream(
    bronze: DataFrame,
    paths: Paths,
    trigger: dict | None = None,
    order: Sequence[str | Column] = ARRIVAL_ORDER,
    rules: FraudRules = FraudRules(),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """``bronze`` is a stream of messages as ``operators.bronze.to_bronze`` gives them.

    One ledger has one writer: two streams that add to it at once could both miss the other's rows.
    """
    spark = bronze.sparkSession
    create_ledger(spark, paths)
    # The micro-batch's own time, which a replay repeats.
    messages = ledger.parse(bronze).withColumn("created_at", F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        write_first_seen(batch, batch_id, query_id(batch), paths, rules, broadcast_bytes)

    writer = (
        ledger.first_seen(messages, order)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", paths.checkpoint("ledger_by_id"))
        .queryName("ledger")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    # The number of state partitions is the session's at the first start, for good: size it for all ids to come.
    with settings(spark, **state_store(spark)):
        return writer.start()

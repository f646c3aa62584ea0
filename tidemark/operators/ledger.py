"""The ledger of transactions, in which the first write of an id wins, and its fraud alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import FraudRules
from tidemark.functions import parsing, risk
from tidemark.functions.timing import as_instant

KEY = "transaction_id"

# Copies of one id may stand in different partitions of the stream, whose offsets do not compare.
ARRIVAL_ORDER = ("timestamp", "partition", "offset")

# Row header, pointers and padding of one id in a hash table, generously.
KEY_OVERHEAD_BYTES = 64


def parse(bronze: DataFrame) -> DataFrame:
    """Typed payloads for the ledger, with their place in the stream.

    Unlike silver, an amount written as text is accepted, and a time is taken as written: the ledger's
    column has no zone and the unusual hours are those of the payer's clock.
    """
    position = [name for name in schemas.ARRIVAL.fieldNames() if name in bronze.columns]
    fields = bronze.select(*position, parsing.json_fields("json_data", schemas.PAYLOAD_TEXT))
    typed = fields.withColumns(
        {
            "amount": parsing.number("amount"),
            "transaction_timestamp": parsing.wall_clock("transaction_timestamp"),
        }
    )
    return typed.where(F.col(KEY).isNotNull() & F.col("amount").isNotNull())


def score(transactions: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Adds is_fraud, fraud_score and reason, judged on the amount before any rounding."""
    return transactions.withColumns(
        risk.score_columns(F.col("amount"), F.col("transaction_timestamp"), rules)
    )


def first_arrivals(
    transactions: DataFrame, order: Sequence[str | Column] = ARRIVAL_ORDER
) -> DataFrame:
    """One row per id, the earliest in ``order``, which must not tie within an id.

    Spark limits each id to one row per task before the shuffle, so an id that is repeated without end
    costs one row per task. Rows without their place in the stream are refused where it decides: any copy could win,
    and another one in a replay.
    """
    if order is ARRIVAL_ORDER:
        order = [_known(name) for name in order]
    window = Window.partitionBy(KEY).orderBy(*order)
    ranked = transactions.withColumn("_arrival", F.row_number().over(window))
    return ranked.where(F.col("_arrival") == 1).drop("_arrival")


def first_seen(messages: DataFrame, order: Sequence[str | Column] = ARRIVAL_ORDER) -> DataFrame:
    """The first arrival of every id of a stream, as streaming state, with ``created_at`` of the micro-batch it came in.

    ``messages`` has ``created_at``, one value per micro-batch. Of an id that a micro-batch brings, one row comes out:
    the first arrival ever, and in ``updated_at`` the micro-batch's time. The id is new where both are the same.
    Copies in one micro-batch are told apart by ``order``; partial aggregation leaves one row per id and task.
    """
    if order is ARRIVAL_ORDER:
        order = [_known(name) for name in order]
    fields = [name for name in messages.columns if name not in (KEY, *schemas.ARRIVAL.fieldNames())]
    places = [(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]
    first = F.min_by(F.struct(*fields), F.struct("created_at", *places)).alias("first")
    return messages.groupBy(KEY).agg(first, F.max("created_at").alias("updated_at")).select(KEY, "first.*", "updated_at")


def _known(name: str) -> Column:
    refused = F.raise_error(F.lit(f"a message has no {name}; give an order of your own"))
    return F.coalesce(F.col(name), refused)


def key_bytes(candidates: DataFrame) -> DataFrame:
    """One row: an upper estimate of the memory a hash table of the ids takes."""
    size = F.sum(F.octet_length(KEY)) + F.count("*") * KEY_OVERHEAD_BYTES
    return candidates.agg(F.coalesce(size, F.lit(0)).alias("bytes"))


def matching_keys(existing: DataFrame, candidates: DataFrame, broadcast: bool = False) -> DataFrame:
    """The ledger's ids that occur among the candidates.

    The ledger is the streamed side. With ``broadcast``, for candidates of a checked size, its id column
    is scanned in place and never shuffled. Otherwise both sides are shuffled and sorted on the id, which
    spills to disk at any size.
    """
    keys = candidates.select(KEY).hint("broadcast" if broadcast else "merge")
    return existing.select(KEY).join(keys, KEY, "left_semi")


def not_in(candidates: DataFrame, keys: DataFrame, broadcast: bool = False) -> DataFrame:
    """Candidates whose id is not among the keys. ``broadcast`` is for keys of a checked size."""
    keys = keys.select(KEY)
    return candidates.join(keys.hint("broadcast") if broadcast else keys, KEY, "left_anti")


def entries(scored: DataFrame, created_at: datetime | str | Column | None = None) -> DataFrame:
    """Scored transactions in the types of the ledger table.

    An amount the decimal cannot hold is null there; ``amount_sent`` has every amount as it was sent.
    """
    return scored.withColumns(
        {
            "amount_sent": F.col("amount"),
            "amount": F.col("amount").try_cast("decimal(12,2)"),
            "transaction_timestamp": F.col("transaction_timestamp").cast("timestamp_ntz"),
            "created_at": as_instant(created_at),
        }
    ).select(schemas.LEDGER.fieldNames())


def new_transactions(
    batch: DataFrame,
    existing: DataFrame,
    order: Sequence[str | Column] = ARRIVAL_ORDER,
    created_at: datetime | str | Column | None = None,
    rules: FraudRules = FraudRules(),
) -> DataFrame:
    """The ledger rows a batch adds: first arrival of every id that the ledger does not hold.

    The de-duplication has already put the batch in partitions by id, so the anti-join moves only the
    ledger's id column.
    """
    return not_in(entries(score(first_arrivals(batch, order), rules), created_at), existing)


def transactions(ledger: DataFrame) -> DataFrame:
    return ledger.select(schemas.TRANSACTIONS.fieldNames())


def fraud_alerts(ledger: DataFrame) -> DataFrame:
    """One alert per fraudulent row of the ledger."""
    return ledger.where("is_fraud").select(
        KEY, F.col("fraud_score").cast("decimal(5,2)").alias("fraud_score"), "reason", "created_at"
    )

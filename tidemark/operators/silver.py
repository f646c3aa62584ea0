"""Typed transactions with derived features. Narrow operators only: nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import Thresholds
from tidemark.functions import features, parsing


# Where the parser leaves a text that it could not read whole.
UNREAD_OPTIONS = {"columnNameOfCorruptRecord": schemas.UNREAD.fieldNames()[0]}


def parse(bronze: DataFrame) -> DataFrame:
    """JSON text to typed columns. Unreadable text gives a row of nulls."""
    fields = bronze.select(parsing.json_fields("json_data", schemas.PAYLOAD))
    return fields.withColumn("transaction_timestamp", parsing.instant("transaction_timestamp"))


def valid(parsed: DataFrame) -> DataFrame:
    """Rows with an id and an amount; no other field is required."""
    return parsed.where(F.col("transaction_id").isNotNull() & F.col("amount").isNotNull())


def judged(bronze: DataFrame) -> DataFrame:
    """Every message with its fields, parsed once, and why silver has no row of it: null if it has.

    A field of the wrong kind is null, as silver has it; a text is unreadable if nothing of it could be read.
    """
    schema = schemas.extend(schemas.PAYLOAD, schemas.UNREAD)
    fields = bronze.select("json_data", F.inline(F.array(F.from_json("json_data", schema, UNREAD_OPTIONS))))
    lost = F.col("transaction_id").isNull() & F.col("amount").isNull() & F.col("unread").isNotNull()
    reason = (
        F.when(F.col("json_data").isNull(), "no message")
        .when(lost, "unreadable")
        .when(F.col("transaction_id").isNull(), "no id")
        .when(F.col("amount").isNull(), "no amount")
    )
    return fields.withColumn("reason", reason).drop("unread")


def rejects(bronze: DataFrame) -> DataFrame:
    """The messages that silver leaves out, as they came, and why."""
    return judged(bronze).where(F.col("reason").isNotNull()).select("json_data", "reason")


def reject_counts(bronze: DataFrame) -> DataFrame:
    """Messages left out, per reason."""
    return rejects(bronze).groupBy("reason").agg(F.count("*").alias("n"))


def add_features(transactions: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    amount, event_time = F.col("amount"), F.col("transaction_timestamp")
    return transactions.withColumns(
        {
            "is_high_value": features.is_high_value(amount, thresholds),
            "is_night_transaction": features.is_night(event_time, thresholds),
            "risk_level": features.risk_level(amount, thresholds),
        }
    )


def to_silver(bronze: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Bronze to silver. Repeated transactions are kept; only the ledger removes them."""
    return add_features(valid(parse(bronze)), thresholds).select(schemas.SILVER.fieldNames())

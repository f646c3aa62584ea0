"""Declared schemas of every layer, so that a job can start before its upstream has written a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


def extend(schema: StructType, *others: StructType) -> StructType:
    """The fields of several schemas, in order, as a new schema."""
    return StructType([f for s in (schema, *others) for f in s.fields])


# Where a record stood in the message stream. Present in bronze when the source has it.
ARRIVAL = _schema(topic=StringType(), partition=IntegerType(), offset=LongType(), timestamp=TimestampType())

# The part of the message source's schema that the jobs use.
MESSAGES = extend(_schema(value=BinaryType()), ARRIVAL)

PAYLOAD = _schema(
    transaction_id=StringType(),
    user_id=StringType(),
    merchant_id=StringType(),
    amount=DoubleType(),
    payment_type=StringType(),
    city=StringType(),
    transaction_timestamp=StringType(),
)

# A text that was not read whole.
UNREAD = _schema(unread=StringType())

# Messages that silver leaves out.
REJECTS = _schema(json_data=StringType(), reason=StringType())

# The ledger accepts an amount written as a number or as text, so it is read as text and coerced.
PAYLOAD_TEXT = StructType([StructField(f.name, StringType(), True) for f in PAYLOAD.fields])

BRONZE = extend(_schema(json_data=StringType()), ARRIVAL)

SILVER_BASE = StructType(
    [*PAYLOAD.fields[:-1], StructField("transaction_timestamp", TimestampType(), True)]
)

SILVER = extend(
    SILVER_BASE,
    _schema(is_high_value=BooleanType(), is_night_transaction=BooleanType(), risk_level=StringType()),
)


def gold(dimension: str) -> StructType:
    """A metrics history: one row per dimension value and snapshot."""
    return extend(
        StructType([StructField(dimension, StringType(), True)]),
        _schema(
            transaction_count=LongType(),
            total_amount=DoubleType(),
            avg_amount=DoubleType(),
            snapshot_time=TimestampType(),
        ),
    )


def only(schema: StructType, names: Sequence[str]) -> StructType:
    """The named fields of a schema."""
    return StructType([schema[name] for name in names])


# The metrics of the dimension values that one micro-batch changed.
CHANGES = _schema(
    dimension=StringType(),
    value=StringType(),
    transaction_count=LongType(),
    total_amount=DoubleType(),
    avg_amount=DoubleType(),
    snapshot_time=TimestampType(),
)

TRANSACTIONS = _schema(
    transaction_id=StringType(),
    user_id=StringType(),
    merchant_id=StringType(),
    amount=DecimalType(12, 2),
    payment_type=StringType(),
    city=StringType(),
    # As written in the message, without a zone.
    transaction_timestamp=TimestampNTZType(),
    created_at=TimestampType(),
)

# A transaction's score is stored beside it: alerts are then a filter on the rows already written. So is the amount
# as it was sent, which the decimal column may be too narrow for.
SCORES = _schema(is_fraud=BooleanType(), fraud_score=IntegerType(), reason=StringType(), amount_sent=DoubleType())

LEDGER = extend(TRANSACTIONS, SCORES)

FRAUD_ALERTS = _schema(
    transaction_id=StringType(),
    fraud_score=DecimalType(5, 2),
    reason=StringType(),
    created_at=TimestampType(),
)

# Directory levels of tables written batch by batch.
BATCH_LEVELS = _schema(stream=StringType(), fold=LongType(), batch=LongType())

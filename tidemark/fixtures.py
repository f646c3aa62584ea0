"""The driver's test tables as payments: transactions, messages, deliveries and histories.

See FIXTURES.md. Everything is derived by Spark from whole tables, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import TOP_N
from tidemark.functions.features import risk_level
from tidemark.operators import gold
from tidemark.session import scratch_path
from tidemark.sinks import append_batch
from tidemark.sources import parquet_table

PAYMENT_TYPES = ("UPI", "CREDIT_CARD", "DEBIT_CARD", "NET_BANKING")
SNAPSHOT_TIMES = ("1996-01-01", "1998-01-01", "2000-01-01", "2002-01-01")

# Transactions before this time are already in the ledger when the batch arrives.
LEDGER_UNTIL = "1997-01-01"
# The payment type whose messages the network delivers twice, and by how much the copy is off.
REPEATED_TYPE = "UPI"
REPEAT_SURCHARGE = 1.0


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven payload columns, timestamp as a wall clock. One row per order."""
    orders, customer, nation = (
        spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "customer", "nation")
    )
    key = F.col("o_orderkey")
    types = F.array(*[F.lit(name) for name in PAYMENT_TYPES])
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("string").alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            (100 + key % 900).cast("string").alias("merchant_id"),
            (F.floor("o_totalprice") / F.lit(100.0)).alias("amount"),
            types[(key % 4).cast("int")].alias("payment_type"),
            F.col("n_name").alias("city"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=((key * 7) % 24).cast("int"))).alias(
                "transaction_timestamp"
            ),
        )
    )


def with_instants(tx: DataFrame) -> DataFrame:
    return tx.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))


def json_messages(tx: DataFrame, *others: str) -> DataFrame:
    """The message texts, beside any other columns asked for."""
    payload = [F.col(name) for name in schemas.PAYLOAD.fieldNames()[:-1]]
    time = F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("transaction_timestamp")
    return tx.select(F.to_json(F.struct(*payload, time)).alias("json_data"), *others)


def delivered(tx: DataFrame) -> DataFrame:
    """The transactions as messages of a stream with four partitions: adds the place of each."""
    number = F.col("transaction_id").cast("bigint")
    return tx.withColumns(
        {
            "topic": F.lit("transactions_raw"),
            "partition": (number % 4).cast("int"),
            "offset": number,
            "timestamp": F.col("transaction_timestamp").cast("timestamp"),
        }
    )


def _copy_of(delivery: DataFrame) -> list[Column]:
    """The columns of a later copy, with another amount."""
    changed = {
        "amount": F.col("amount") + REPEAT_SURCHARGE,
        "timestamp": F.col("timestamp") + F.expr("INTERVAL 20 YEARS"),
    }
    return [changed.get(name, F.col(name)).alias(name) for name in delivery.columns]


def repeated(delivery: DataFrame) -> DataFrame:
    """Later copies of one payment type's messages."""
    return delivery.where(F.col("payment_type") == REPEATED_TYPE).select(_copy_of(delivery))


def with_repeats(delivery: DataFrame) -> DataFrame:
    """The messages and their later copies, from one pass."""
    original, copy = F.struct(*delivery.columns), F.struct(*_copy_of(delivery))
    sent = F.when(F.col("payment_type") == REPEATED_TYPE, F.array(original, copy)).otherwise(F.array(original))
    return delivery.select(F.inline(sent))


def already_in_ledger(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("transaction_timestamp") < F.lit(LEDGER_UNTIL).cast("timestamp_ntz"))


def damaged(tx: DataFrame) -> DataFrame:
    """Messages of all transactions; those of some orders are cut off, lack a field or have one of the wrong kind."""
    kind = F.col("transaction_id").cast("long") % 10
    broken = tx.withColumns(
        {
            "kind": kind,
            "transaction_id": F.when(kind != 2, F.col("transaction_id")),
            "amount": F.when(kind != 3, F.col("amount")),
        }
    )
    sent = F.to_json(F.struct(*schemas.PAYLOAD.fieldNames()))
    text = (
        F.when(F.col("kind") == 1, F.substring(sent, 1, 9))
        .when(F.col("kind") == 4, F.regexp_replace(sent, '"amount":[^,]*', '"amount":"much"'))
        .when(F.col("kind") != 5, sent)
    )
    return broken.select(text.alias("json_data"))


def write_bronze(messages: DataFrame, path: str, batches: int = 1) -> None:
    """Appends a delivery of messages to a bronze table."""
    columns = [
        (F.col(f.name) if f.name in messages.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.BRONZE.fields
    ]
    deliver(messages.select(*columns), path, batches)


def deliver(rows: DataFrame, path: str, batches: int = 1) -> None:
    """Appends rows to a table, dealt to some batches."""
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(batches))
    for number in range(batches):
        append_batch(rows.where(part == number), path)


def cumulative(tx: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counts and sums up to each snapshot time, per combination of dimension values.

    The transactions are aggregated once, with one pair of conditional aggregates per snapshot, instead
    of being joined to the snapshot times.
    """
    columns = []
    for time in SNAPSHOT_TIMES:
        before = F.col("transaction_timestamp") < F.lit(time).cast("timestamp_ntz")
        columns.append(F.count_if(before).alias(f"n_{time}"))
        columns.append(F.sum(F.when(before, F.col("amount"))).alias(f"s_{time}"))
    rows = [
        F.struct(
            F.lit(time).cast("timestamp").alias("snapshot_time"),
            F.col(f"n_{time}").alias("transaction_count"),
            F.col(f"s_{time}").alias("total_amount"),
        )
        for time in SNAPSHOT_TIMES
    ]
    measured = tx.groupBy(*dimensions).agg(*columns)
    return measured.select(*dimensions, F.inline(F.array(*rows))).where(F.col("transaction_count") > 0)


def histories(spark: SparkSession, sf_dir: str, *dimensions: str) -> tuple[DataFrame, ...]:
    """Metrics histories as tables at rest, one per dimension, from a single pass over the transactions."""
    root = scratch_path(spark, "history")
    tx = transactions(spark, sf_dir).withColumn("risk_level", risk_level(F.col("amount")))
    cube = cumulative(tx, dimensions)
    if len(dimensions) > 1:
        cube.write.parquet(f"{root}/cube")
        cube = spark.read.schema(cube.schema).parquet(f"{root}/cube")
    for dimension in dimensions:
        _history(cube, dimension).write.parquet(f"{root}/{dimension}")
    return tuple(
        parquet_table(spark, f"{root}/{dimension}", schemas.gold(dimension)) for dimension in dimensions
    )


def _history(cube: DataFrame, dimension: str) -> DataFrame:
    total, n = F.sum("total_amount"), F.sum("transaction_count")
    history = cube.groupBy(dimension, "snapshot_time").agg(
        n.alias("transaction_count"),
        F.round(total, 2).alias("total_amount"),
        F.round(total / n, 4).alias("avg_amount"),
    )
    if TOP_N[dimension] is not None:
        ranked = Window.partitionBy("snapshot_time").orderBy(*gold.by_count(dimension))
        history = history.withColumn("_rank", F.row_number().over(ranked))
        history = history.where(F.col("_rank") <= TOP_N[dimension]).drop("_rank")
    return history.select(schemas.gold(dimension).fieldNames())

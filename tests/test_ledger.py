from decimal import Decimal

import pytest
from helpers import messages, payload, rows, texts
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ledger
from tidemark.session import settings

AT = "2001-01-01 00:00:00"


def new(spark, batch, existing=()):
    known = spark.createDataFrame([(i,) for i in existing], "transaction_id string")
    return ledger.new_transactions(ledger.parse(batch), known, created_at=AT)


def test_schema(spark):
    found = new(spark, messages(spark, payload("a")))
    assert found.select(schemas.LEDGER.fieldNames()).dtypes == spark.createDataFrame([], schemas.LEDGER).dtypes
    assert ledger.transactions(found).dtypes == spark.createDataFrame([], schemas.TRANSACTIONS).dtypes
    assert ledger.fraud_alerts(found).dtypes == spark.createDataFrame([], schemas.FRAUD_ALERTS).dtypes


def test_first_arrival_wins_in_a_batch_and_against_the_ledger(spark):
    batch = messages(
        spark, payload("a", 5000.0), payload("b", 1.0), payload("a", 2.0), payload("c", 3.0), payload("b", 4200.0)
    )
    found = new(spark, batch.orderBy(F.desc("offset")), existing=["c"])
    assert rows(found, "transaction_id", "amount", "fraud_score") == [
        ("a", Decimal("5000.00"), 95),
        ("b", Decimal("1.00"), 0),
    ]
    assert rows(ledger.fraud_alerts(found), "transaction_id", "fraud_score", "reason") == [
        ("a", Decimal("95.00"), "Suspicious Very High Amount")
    ]


def test_copies_in_other_partitions_are_ordered_by_time(spark):
    one = messages(spark, payload("a", 1.0), first=900)
    other = messages(spark, payload("a", 2.0), first=100).withColumn("partition", F.lit(3))
    late = other.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY")).withColumn(
        "offset", F.lit(1).cast("long")
    )
    assert rows(new(spark, one.unionByName(other)), "amount") == [(Decimal("2.00"),)]
    assert rows(new(spark, one.unionByName(late)), "amount") == [(Decimal("1.00"),)]


def test_score_uses_the_amount_before_rounding(spark):
    found = new(spark, messages(spark, payload("a", 4500.004), payload("b", 4000.004), payload("c", 12.345)))
    assert rows(found, "transaction_id", "amount", "fraud_score") == [
        ("a", Decimal("4500.00"), 95),
        ("b", Decimal("4000.00"), 80),
        ("c", Decimal("12.35"), 0),
    ]


def test_an_amount_too_large_for_the_table_keeps_its_row_and_alert(spark):
    found = new(spark, messages(spark, payload("a", 1e11), payload("b", "NaN"), payload("c", "Infinity")))
    assert rows(found, "transaction_id", "amount", "fraud_score") == [("a", None, 95), ("b", None, 0), ("c", None, 95)]
    sent = {r["transaction_id"]: r["amount_sent"] for r in found.collect()}
    assert sent["a"] == 1e11 and sent["c"] == float("inf") and sent["b"] != sent["b"]


def test_messages_without_their_place_are_refused(spark):
    known = messages(spark, payload("a"), payload("a"))
    for name in ("partition", "offset", "timestamp"):
        kind = dict(known.dtypes)[name]
        with pytest.raises(Exception, match=f"a message has no {name}"):
            new(spark, known.withColumn(name, F.lit(None).cast(kind))).collect()


def test_a_time_that_a_zone_skips_is_kept(spark):
    """02:30 of that day is left out in New York."""
    with settings(spark, spark__sql__session__timeZone="America/New_York"):
        found = new(spark, messages(spark, payload("a", at="2024-03-10T02:30:00")))
        assert found.select(F.col("transaction_timestamp").cast("string")).first()[0] == "2024-03-10 02:30:00"


def test_time_is_stored_as_written(spark):
    found = new(spark, messages(spark, payload("a", at="2001-02-03T23:00:00-05:00"), payload("b", at="x")))
    text = F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm").alias("at")
    assert rows(found.select("transaction_id", text)) == [("a", "2001-02-03 23:00"), ("b", None)]


def test_null_and_numeric_ids(spark):
    found = new(spark, messages(spark, payload(None), payload(7), payload("7", 99.0)))
    assert rows(found, "transaction_id", "amount") == [("7", Decimal("10.00"))]


def test_a_hot_id_is_reduced_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "bronze")
    hot = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.lit(5.0).alias("amount"), F.lit(None).cast("timestamp").alias("transaction_timestamp"),
        F.lit(0).alias("partition"), (30_000 - F.col("id")).alias("offset"),
        F.timestamp_seconds(F.lit(0)).alias("timestamp"),
    )
    hot.write.parquet(path)
    first = ledger.first_arrivals(spark.read.parquet(path))
    assert first.count() == 20_001
    assert first.where("transaction_id = 'hot'").first()["offset"] == 30_000 - 29_997
    plan = first._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning(transaction_id") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_comparison_with_the_ledger(spark, tmp_path):
    big, small = str(tmp_path / "ledger"), str(tmp_path / "batch")
    ids = F.col("id").cast("string").alias("transaction_id")
    spark.range(100_000).select(ids, F.lit("x").alias("city")).write.parquet(big)
    spark.range(99_990, 100_010).select(ids).write.parquet(small)
    existing, batch = spark.read.parquet(big), spark.read.parquet(small)
    for broadcast in (True, False):
        matching = ledger.matching_keys(existing, batch, broadcast)
        plan = matching._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning" in plan) is not broadcast
        assert ("BroadcastHashJoin" in plan) is broadcast and ("SortMergeJoin" in plan) is not broadcast
        assert "ReadSchema: struct<transaction_id:string>" in plan
        added = ledger.not_in(batch, matching, broadcast)
        assert rows(added) == [(str(i),) for i in range(100_000, 100_010)]
    assert ledger.key_bytes(batch).first()["bytes"] == 20 * 64 + 10 * 5 + 10 * 6
    assert ledger.key_bytes(batch.limit(0)).first()["bytes"] == 0


def test_arrival_columns_are_optional_with_an_order_of_ones_own(spark):
    batch = ledger.parse(texts(spark, payload("a", 9.0), payload("a", 1.0)))
    first = ledger.first_arrivals(batch, [F.col("amount")])
    assert rows(first, "amount") == [(1.0,)]

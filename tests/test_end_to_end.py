"""Messages through every layer to the dashboard's figures, against sums made by hand."""

import random
import uuid
from collections import Counter

from helpers import ALL_NOW, messages, payload, rows
from pyspark.sql import functions as F

from tidemark import journal, schemas, streaming
from tidemark.config import HISTORY_TABLES, JdbcTarget
from tidemark.operators import monitor
from tidemark.plans import dashboard, serving
from tidemark.sources import batch_table, jdbc_recent, parquet_stream


def deliveries():
    rng = random.Random(11)

    def one(id):
        return {
            "id": id,
            "amount": round(rng.uniform(10, 5000), 2),
            "at": f"2001-02-03T{rng.randrange(24):02}:30:00",
            "payment_type": rng.choice(["UPI", "CREDIT_CARD", "DEBIT_CARD"]),
            "city": rng.choice([f"city {i:02}" for i in range(30)]),
        }

    first = [one(str(i)) for i in range(120)]
    return first, [one(str(i)) for i in range(100, 180)]


def test_messages_to_dashboard(spark, paths):
    target = JdbcTarget(f"jdbc:derby:memory:{uuid.uuid4().hex};create=true")
    for dimension, table in HISTORY_TABLES.items():
        empty = spark.createDataFrame([], schemas.gold(dimension)).write
        empty.option("createTableColumnTypes", f"{dimension} VARCHAR(100)").jdbc(target.url, table)

    first, second = deliveries()
    for number, delivery in enumerate((first, second)):
        arriving = messages(spark, *[payload(**d) for d in delivery], first=1000 * number)
        arriving.withColumn("value", F.col("json_data").cast("binary")).coalesce(1).write.mode("append").parquet(
            f"{paths.root}/topic"
        )
        topic = parquet_stream(spark, f"{paths.root}/topic", schemas.MESSAGES)
        streaming.bronze_stream(topic, paths, ALL_NOW).awaitTermination()
        streaming.silver_stream(spark, paths, ALL_NOW).awaitTermination()
        streaming.gold_stream(
            spark, paths, trigger=ALL_NOW, clock=lambda: f"2001-01-0{number + 1} 00:00:00"
        ).awaitTermination()
        bronze = journal.rows(journal.entries(spark, paths.bronze, "ledger"), schemas.BRONZE)
        streaming.ledger_stream(bronze, paths, ALL_NOW).awaitTermination()
        results = serving.sync_all(spark, serving.histories(spark, paths), target)
        assert all(r.error is None and r.rows > 0 for r in results)

    # Silver and gold keep repeated transactions.
    everything = first + second
    recent = {t: jdbc_recent(spark, target, t) for t in HISTORY_TABLES.values()}
    shown = dashboard.frames(recent, dashboard.served_trends(spark, target))
    (summary,) = shown["summary"].collect()
    assert (summary["total_transactions"], summary["previous_transactions"]) == (200, 120)
    assert round(summary["total_revenue"], 2) == round(sum(d["amount"] for d in everything), 2)
    assert round(summary["previous_revenue"], 2) == round(sum(d["amount"] for d in first), 2)
    assert summary["high_risk_transactions"] == sum(d["amount"] > 4000 for d in everything)
    assert summary["high_risk_delta"] == sum(d["amount"] > 4000 for d in second)
    assert summary["cities_covered"] == 20
    assert [r["transactions"] for r in shown["transaction_trend"].collect()] == [120, 200]
    assert rows(shown["payment_distribution"]) == sorted(Counter(d["payment_type"] for d in everything).items())
    ranked = sorted(Counter(d["city"] for d in everything).items(), key=lambda c: (-c[1], c[0]))
    assert [tuple(r) for r in shown["top_cities"].collect()] == ranked[:10]

    checked = monitor.freshness(serving.table_report(spark, target), "2001-01-02 00:03:00")
    assert rows(checked, "table_name", "age_minutes", "status") == sorted(
        (t, 3.0, "OK") for t in HISTORY_TABLES.values()
    )

    # The ledger keeps the first of each.
    kept = {d["id"]: d for d in reversed(everything)}
    ledger = batch_table(spark, paths.ledger, schemas.LEDGER)
    assert rows(ledger.select("transaction_id", F.col("amount").cast("double"))) == sorted(
        (i, d["amount"]) for i, d in kept.items()
    )
    flagged = {i for i, d in kept.items() if d["amount"] > 4000 or int(d["at"][11:13]) <= 4}
    alerts = batch_table(spark, paths.alerts, schemas.FRAUD_ALERTS)
    assert rows(alerts, "transaction_id") == sorted((i,) for i in flagged)

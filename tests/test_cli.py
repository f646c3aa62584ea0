from types import SimpleNamespace

import pytest
from helpers import history, messages, payload, rows, silver_rows
from pyspark.sql import functions as F

from tidemark import cli, fixtures, schemas
from tidemark.config import HISTORY_TABLES
from tidemark.operators import ledger
from tidemark.sinks import write_batch
from tidemark.sources import batch_table
from tidemark.streaming.ledger import create_ledger, write_ledger_batch


@pytest.fixture
def lake(spark, paths, monkeypatch):
    monkeypatch.delenv("TIDEMARK_JDBC_URL", raising=False)
    for dimension, value in (("payment_type", "UPI"), ("risk_level", "HIGH"), ("city", "a")):
        data = history(spark, dimension, (value, 2, 20, "2001-01-01 00:00:00"))
        write_batch(data, paths.history(dimension), "s", 0)
    return paths


def test_gold_job(spark, paths):
    fixtures.deliver(silver_rows(spark, ("1", 10.0, "UPI", "A", "LOW")), paths.silver)
    cli.main(["gold", "--root", paths.root, "--once"])
    for dimension, value in (("payment_type", "UPI"), ("risk_level", "LOW"), ("city", "A")):
        table = batch_table(spark, paths.history(dimension), schemas.gold(dimension))
        assert rows(table, dimension, "transaction_count") == [(value, 1)]


def test_reports(lake, capsys):
    cli.main(["report", "--root", lake.root])
    cli.main(["dashboard", "--root", lake.root])
    shown = capsys.readouterr().out
    assert "city_metrics_history" in shown and "revenue_trend" in shown and "$20.00" in shown


def test_dashboard_shows_the_newest_snapshots_and_writes_all(spark, lake, paths, capsys):
    for day in range(1, 26):
        data = history(spark, "payment_type", ("UPI", day, 10 * day, f"2001-02-{day:02} 00:00:00"))
        write_batch(data, paths.history("payment_type"), "s", day)
    cli.main(["dashboard", "--root", lake.root])
    shown = capsys.readouterr().out
    trend = shown[shown.index("revenue_trend") : shown.index("transaction_trend")]
    assert "the newest 20 of 26 rows" in trend and "2001-02-25" in trend and "2001-02-06" in trend
    assert "2001-02-05" not in trend
    cli.main(["dashboard", "--root", lake.root, "--last", "30"])
    shown = capsys.readouterr().out
    assert "revenue_trend: 26 rows" in shown and "2001-01-01" in shown
    cli.main(["dashboard", "--root", lake.root, "--out", f"{paths.root}/frames"])
    assert spark.read.parquet(f"{paths.root}/frames/revenue_trend").count() == 26


def test_health(lake):
    cli.main(["health", "--root", lake.root, "--as-of", "2001-01-01 00:10:00"])
    with pytest.raises(RuntimeError, match="payment_metrics_history: the newest snapshot, of 2001-01-01 .*, is 10.02 minutes old"):
        cli.main(["health", "--root", lake.root, "--as-of", "2001-01-01 00:10:01"])


def test_backfill_and_sync(spark, lake, monkeypatch, capsys):
    url = "jdbc:derby:memory:cli;create=true"
    monkeypatch.setenv("TIDEMARK_JDBC_URL", url)
    for dimension, table in HISTORY_TABLES.items():
        # This database cannot compare the text type Spark would choose.
        empty = spark.createDataFrame([], schemas.gold(dimension)).write
        empty.option("createTableColumnTypes", f"{dimension} VARCHAR(100)").jdbc(url, table)
    create_ledger(spark, lake)
    batch = ledger.parse(messages(spark, payload("a", 4600.0), payload("b", 1.0)))
    write_ledger_batch(batch.withColumn("created_at", F.current_timestamp()), 0, "s", lake)
    cli.main(["backfill", "--root", lake.root])
    cli.main(["sync", "--root", lake.root])
    shown = capsys.readouterr().out
    assert "payment_metrics_history: 1 rows after None" in shown
    assert "payment_metrics_history: 0 rows after 2001-01-01 00:00:00" in shown
    assert "transactions: 2 rows after None" in shown and "fraud_alerts: 1 rows after None" in shown
    assert shown.count("transactions: 0 rows after 2") == 1 and shown.count("fraud_alerts: 0 rows after 2") == 1
    cli.main(["report", "--root", "elsewhere"])
    cli.main(["dashboard", "--root", "elsewhere"])
    cli.main(["health", "--root", "elsewhere", "--as-of", "2001-01-01 00:00:00"])
    shown = capsys.readouterr().out
    assert "city_metrics_history" in shown and "$20.00" in shown and "OK" in shown


def test_arguments():
    args = cli.parser().parse_args(["ledger", "--root", "r", "--servers", "k:1", "--every", "10 seconds"])
    assert cli._trigger(args) == {"processingTime": "10 seconds"} and args.option == []
    assert cli._trigger(cli.parser().parse_args(["gold", "--root", "r"])) == {"processingTime": "1 minute"}
    assert cli._trigger(cli.parser().parse_args(["silver", "--root", "r"])) is None
    assert cli._trigger(cli.parser().parse_args(["silver", "--root", "r", "--once"])) == {"availableNow": True}


class Query:
    def __init__(self, error=None):
        self.error, self.isActive, self.stopped = error, error is None, False

    def exception(self):
        return self.error

    def stop(self):
        self.isActive, self.stopped = False, True


def test_a_failed_query_stops_the_others(spark):
    alive, dead = Query(), Query(RuntimeError("no space"))
    waited = SimpleNamespace(awaitAnyTermination=lambda: None, resetTerminated=lambda: None)
    with pytest.raises(RuntimeError, match="no space"):
        cli.await_all(SimpleNamespace(streams=waited), [alive, dead])
    assert alive.stopped and dead.stopped
    cli.await_all(spark, [])


def test_load_job(spark, lake, monkeypatch, capsys):
    monkeypatch.setenv("TIDEMARK_JDBC_URL", "jdbc:derby:memory:loadjob;create=true")
    monkeypatch.setenv("TIDEMARK_JDBC_DRIVER", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    create_ledger(spark, lake)
    for rows_ in (1, 0):
        cli.main(["load", "--root", lake.root, "--writers", "2"])
        shown = capsys.readouterr().out
        assert f"city_metrics_history: {rows_} rows of" in shown and "fraud_alerts: 0 rows" in shown

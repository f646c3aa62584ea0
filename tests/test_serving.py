"""The serving database is an embedded, in-memory one: no server, no port."""

import uuid

import pytest
from helpers import history, messages, payload, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import HISTORY_TABLES, JdbcTarget
from tidemark.operators import ledger, monitor
from tidemark.plans import dashboard, serving
from tidemark.sinks import jdbc_append, write_batch
from tidemark.sources import jdbc_high_water_mark, jdbc_recent, jdbc_table
from tidemark.sources.jdbc import quoted
from tidemark.streaming.ledger import create_ledger, write_ledger_batch

T1, T2, T3, T4 = (f"2001-01-0{i} 00:00:00.123456" for i in (1, 2, 3, 4))
TABLE = "payment_metrics_history"


@pytest.fixture
def target():
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    return JdbcTarget(url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


def payments(spark, *times):
    values = [(kind, 1, 10, t) for t in times for kind in ("UPI", None)]
    return history(spark, "payment_type", *values) if values else spark.createDataFrame([], schemas.gold("payment_type"))


def test_first_sync_loads_everything_then_only_what_is_newer(spark, target):
    jdbc_append(payments(spark), target, TABLE)
    assert jdbc_high_water_mark(spark, target, TABLE) is None
    first = serving.sync(spark, payments(spark, T1, T2), target, TABLE)
    assert (first.mark, first.rows) == (None, 4)
    second = serving.sync(spark, payments(spark, T1, T2, T3), target, TABLE)
    assert second.rows == 2 and second.mark is not None
    third = serving.sync(spark, payments(spark, T1, T2, T3), target, TABLE)
    assert third.rows == 0
    assert rows(jdbc_table(spark, target, TABLE)) == rows(payments(spark, T1, T2, T3))


def test_late_snapshots_behind_the_mark_are_not_loaded(spark, target):
    jdbc_append(payments(spark, T2), target, TABLE)
    assert serving.sync(spark, payments(spark, T1, T2), target, TABLE).rows == 0


def test_backfill_creates_the_table_and_repeats_safely(spark, target):
    for _ in range(2):
        serving.backfill(spark, payments(spark, T1, T2), target, TABLE)
    assert rows(jdbc_table(spark, target, TABLE)) == rows(payments(spark, T1, T2))


def test_large_loads_are_cut_into_whole_snapshots(spark, target, monkeypatch):
    sizes = []

    def counted(df, *others):
        sizes.append((df.count(), df.select("snapshot_time").distinct().count()))
        jdbc_append(df, *others)

    monkeypatch.setattr(serving, "jdbc_append", counted)
    jdbc_append(payments(spark), target, TABLE)
    data = payments(spark, T1, T2, T3, T4)
    result = serving.sync(spark, data, target, TABLE, rows_per_transaction=4)
    assert result.rows == 8
    assert sizes == [(4, 2), (4, 2)]
    assert rows(jdbc_table(spark, target, TABLE)) == rows(data)


def test_an_interrupted_load_continues_where_it_stopped(spark, target, monkeypatch):
    done = []

    def failing(df, *others):
        if len(done) == 2:
            raise RuntimeError("database lost")
        done.append(df)
        jdbc_append(df, *others)

    jdbc_append(payments(spark), target, TABLE)
    data = payments(spark, T4, T2, T3, T1)
    with monkeypatch.context() as patched:
        patched.setattr(serving, "jdbc_append", failing)
        with pytest.raises(RuntimeError):
            serving.sync(spark, data, target, TABLE, rows_per_transaction=2)
    assert rows(jdbc_table(spark, target, TABLE)) == rows(payments(spark, T1, T2))
    assert serving.sync(spark, data, target, TABLE).rows == 4
    assert rows(jdbc_table(spark, target, TABLE)) == rows(data)


def untimed(spark, *times):
    return payments(spark, *times).unionByName(
        spark.createDataFrame([("CASH", 1, 1.0, 1.0, None)], schemas.gold("payment_type"))
    )


@pytest.mark.parametrize("times", [(T1, T2, T3), ()])
@pytest.mark.parametrize("size", [2, 100])
def test_a_backfill_loads_rows_without_a_time_once(spark, target, times, size):
    data = untimed(spark, *times)
    first = serving.backfill(spark, data, target, TABLE, rows_per_transaction=size)
    assert (first.rows, first.untimed) == (2 * len(times) + 1, 0)
    again = serving.backfill(spark, data, target, TABLE, rows_per_transaction=size)
    assert (again.rows, again.untimed) == (0, 1)
    assert rows(jdbc_table(spark, target, TABLE)) == rows(data)


def test_ledger_and_alerts_are_served_and_continue_after_a_failure(spark, target, paths, monkeypatch):
    create_ledger(spark, paths)
    sent = [[payload("a", 4600.0), payload("b", "12.34")], [payload("c", 4100.0)]]
    for number, values in enumerate(sent):
        batch = ledger.parse(messages(spark, *values, first=10 * number))
        stamped = batch.withColumn("created_at", F.lit(f"2001-01-0{number + 1} 00:00:00").cast("timestamp"))
        write_ledger_batch(stamped, number, "s", paths)
    tables = serving.payments(spark, paths)
    done = []

    def failing(df, *others):
        if df.columns[0] == "transaction_id" and len(done) == 3:
            raise RuntimeError("database lost")
        done.append(df)
        jdbc_append(df, *others)

    with monkeypatch.context() as patched:
        patched.setattr(serving, "jdbc_append", failing)
        patched.setattr(serving, "ROWS_PER_TRANSACTION", 1)
        found = serving.sync_all(spark, tables, target, load=serving.backfill)
    assert any(r.error for r in found)
    for _ in range(2):
        found = serving.sync_all(spark, tables, target, load=serving.backfill)
        assert not any(r.error for r in found)
    served = {name: jdbc_table(spark, target, name) for name in tables}
    for name, table in tables.items():
        assert rows(served[name].select("transaction_id")) == rows(table.select("transaction_id"))
    kinds = dict(served["transactions"].dtypes)
    assert kinds["amount"] == "decimal(12,2)" and dict(served["fraud_alerts"].dtypes)["fraud_score"] == "decimal(5,2)"


def test_trends_are_grouped_by_the_database(spark, target):
    data = {
        "payment_type": history(spark, "payment_type", ("UPI", 1, 10, T1), ("CARD", 2, 20, T1), ("UPI", 5, 50, T2)),
        "risk_level": history(spark, "risk_level", ("HIGH", 1, 10, T1), ("LOW", 2, 20, T1), ("HIGH", 5, 50, T2)),
    }
    for dimension, df in data.items():
        names = f"{dimension} VARCHAR(100)"
        df.limit(0).write.option("createTableColumnTypes", names).jdbc(target.url, HISTORY_TABLES[dimension], properties=target.properties)
        jdbc_append(df, target, HISTORY_TABLES[dimension])
    served = dashboard.served_trends(spark, target)
    lake = dashboard.lake_trends(
        {HISTORY_TABLES[d]: df for d, df in data.items()} | {HISTORY_TABLES["city"]: data["risk_level"]}
    )
    assert list(served) == list(lake)
    for name in lake:
        assert served[name].collect() == lake[name].collect()


def test_names_are_quoted_as_the_database_wants():
    assert quoted(JdbcTarget("jdbc:mysql://h/d"), "n") == "`n`" and quoted(JdbcTarget("jdbc:postgresql:d"), "n") == '"n"'


def test_a_failing_table_does_not_stop_the_others(spark, target):
    jdbc_append(payments(spark), target, TABLE)
    results = serving.sync_all(spark, {"absent": payments(spark, T1), TABLE: payments(spark, T1)}, target)
    assert [(r.table, r.rows, r.error is None) for r in results] == [("absent", 0, False), (TABLE, 2, True)]


def test_histories_by_serving_table(spark, paths):
    for dimension in ("payment_type", "risk_level", "city"):
        data = history(spark, dimension, ("x", 1, 1, T1))
        write_batch(data, paths.history(dimension), "s", 0)
    found = serving.histories(spark, paths)
    assert list(found) == ["payment_metrics_history", "risk_metrics_history", "city_metrics_history"]
    assert [df.count() for df in found.values()] == [1, 1, 1]
    assert found["city_metrics_history"].columns == schemas.gold("city").fieldNames()


def test_the_mark_is_found_by_the_database(spark, target):
    jdbc_append(payments(spark, T1, T2), target, TABLE)
    assert str(jdbc_high_water_mark(spark, target, TABLE)) == "2001-01-02 00:00:00.123456+00:00"


def test_recent_snapshots_are_chosen_by_the_database(spark, target):
    jdbc_append(payments(spark), target, TABLE)
    assert jdbc_recent(spark, target, TABLE).count() == 0
    for number, at in enumerate((T1, T2, T3)):
        jdbc_append(payments(spark, at), target, TABLE)
        expected = payments(spark, *(T1, T2, T3)[max(0, number - 1) : number + 1])
        assert rows(jdbc_recent(spark, target, TABLE)) == rows(expected)


def test_report_of_the_serving_tables(spark, target):
    for dimension, table in HISTORY_TABLES.items():
        jdbc_append(history(spark, dimension, ("x", 1, 1, T1), ("x", 1, 1, T2)), target, table)
    report = serving.table_report(spark, target)
    assert report.columns == ["table_name", "n_rows", "latest_snapshot"]
    assert rows(report, "table_name", "n_rows") == sorted((t, 2) for t in HISTORY_TABLES.values())
    checked = monitor.freshness(report, T2)
    monitor.assert_fresh(checked, list(HISTORY_TABLES.values()))


def test_credentials_come_from_the_environment():
    target = JdbcTarget.from_env({"TIDEMARK_JDBC_URL": "jdbc:x", "TIDEMARK_JDBC_USER": "u", "TIDEMARK_JDBC_PASSWORD": "p"})
    assert target.properties == {"user": "u", "password": "p"}
    assert "'p'" not in repr(target)

"""Loads by journal into an embedded, in-memory database: no server, no port."""

import uuid

import pytest
from helpers import history, messages, payload, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import JdbcTarget
from tidemark.operators import ledger
from tidemark.plans import loading, serving
from tidemark.sinks import jdbc_append, write_batch
from tidemark.sinks.jdbc import connection, execute, table_exists
from tidemark.sources import jdbc_table
from tidemark.streaming.ledger import create_ledger, write_ledger_batch

T1, T2, T3 = (f"2001-01-0{i} 00:00:00.123456" for i in (1, 2, 3))
TABLE = "payment_metrics_history"


@pytest.fixture
def target():
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    return JdbcTarget(url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


@pytest.fixture(autouse=True)
def forget_failures(spark):
    yield
    # Otherwise whoever next waits for any stream of the session gets the error.
    spark.streams.resetTerminated()


@pytest.fixture
def source(paths):
    return loading.sources(paths)[TABLE]


def payments(spark, *times):
    return history(spark, "payment_type", *[(kind, 1, 10, t) for t in times for kind in ("UPI", "CARD", None)])


def make_table(spark, target):
    """The serving table with a text type that can be compared."""
    empty = spark.createDataFrame([], schemas.gold("payment_type"))
    kinds = "payment_type VARCHAR(100)"
    empty.write.option("createTableColumnTypes", kinds).jdbc(target.url, TABLE, properties=target.properties)


def served(spark, target):
    return rows(jdbc_table(spark, target, TABLE))


def count(spark, target, table):
    with connection(spark, target) as database:
        return execute(database, f"SELECT COUNT(*) FROM {table}")


def test_streams_whose_times_interleave_are_loaded_whole(spark, target, paths, source):
    """Equal and late times are new rows if their batch is new; a pass opens the files of new batches only."""
    place, check = source.path, paths.checkpoint("load")
    write_batch(payments(spark, T2), place, "a", 0)
    first = loading.load(spark, source, target, TABLE, check)
    assert first.rows == 3 and first.files >= 1
    write_batch(payments(spark, T1).coalesce(1), place, "b", 0)
    write_batch(payments(spark, T2).coalesce(1), place, "b", 1)
    second = loading.load(spark, source, target, TABLE, check)
    assert (second.rows, second.files) == (6, 2)
    for number in range(2, 6):
        write_batch(payments(spark, T3).coalesce(1), place, "b", number)
        again = loading.load(spark, source, target, TABLE, check)
        assert (again.rows, again.files) == (3, 1)
    assert loading.load(spark, source, target, TABLE, check).files == 0
    assert served(spark, target) == rows(payments(spark, T2, T1, T2, T3, T3, T3, T3))
    assert count(spark, target, loading.staging(TABLE)) == 0


def test_a_writer_that_fails_half_way_leaves_nothing(spark, target, paths, source, monkeypatch):
    data = payments(spark, *[f"2001-01-01 00:00:{s:02d}" for s in range(40)])
    write_batch(data.repartition(8), source.path, "a", 0)
    real, check, parts = loading.stage, paths.checkpoint("load"), []

    def failing(df, *others):
        lost = F.when(F.col("payment_type") == "CARD", F.raise_error(F.lit("writer lost")).cast("string"))
        some = df.where("payment_type <> 'CARD' or payment_type is null")
        real(some, *others)
        parts.append(count(spark, target, loading.staging(TABLE)))
        real(df.withColumn("payment_type", F.coalesce(lost, "payment_type")), *others)

    with monkeypatch.context() as patched:
        patched.setattr(loading, "stage", failing)
        with pytest.raises(Exception, match="writer lost"):
            loading.load(spark, source, target, TABLE, check)
    assert parts == [80] and count(spark, target, TABLE) == 0

    def seen(df, *others):
        real(df, *others)
        with connection(spark, target) as database:
            parts.append(execute(database, f'SELECT COUNT(DISTINCT "load_part") FROM {loading.staging(TABLE)}'))

    monkeypatch.setattr(loading, "stage", seen)
    assert loading.load(spark, source, target, TABLE, check).rows == 120
    assert parts[1] > 1
    assert served(spark, target) == rows(data)


def test_a_task_that_runs_twice_counts_once(spark, target, paths, source, monkeypatch):
    write_batch(payments(spark, T1, T2), source.path, "a", 0)
    real = loading.stage

    def twice(*all_):
        real(*all_)
        real(*all_)

    monkeypatch.setattr(loading, "stage", twice)
    assert loading.load(spark, source, target, TABLE, paths.checkpoint("load")).rows == 6
    assert served(spark, target) == rows(payments(spark, T1, T2))


def test_a_crash_after_the_transaction_adds_nothing_twice(spark, target, paths, source, monkeypatch):
    write_batch(payments(spark, T1), source.path, "a", 0)
    real, check = loading.take_over, paths.checkpoint("load")

    def crashing(*all_):
        real(*all_)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(loading, "take_over", crashing)
        with pytest.raises(Exception, match="driver lost"):
            loading.load(spark, source, target, TABLE, check)
    assert loading.load(spark, source, target, TABLE, check).rows == 0
    assert served(spark, target) == rows(payments(spark, T1))


def test_a_transaction_that_fails_changes_nothing(spark, target):
    make_table(spark, target)
    with pytest.raises(Exception, match="NOWHERE"):
        with connection(spark, target, transaction=True) as database:
            execute(database, f"INSERT INTO {TABLE} (\"payment_type\") VALUES (?)", "x")
            execute(database, "INSERT INTO nowhere VALUES (1)")
    assert count(spark, target, TABLE) == 0
    assert table_exists(spark, target, TABLE) and not table_exists(spark, target, "nowhere")


def test_tables_that_sync_has_filled_are_adopted_by_key(spark, target, paths, source):
    make_table(spark, target)

    def named(*times):
        # The embedded database takes no null of Spark's text type for a VARCHAR.
        return payments(spark, *times).where("payment_type is not null")

    jdbc_append(named(T2), target, TABLE)
    for number, at in enumerate((T1, T2, T3)):
        write_batch(named(at), source.path, "a", number)
    check = paths.checkpoint("load")
    with pytest.raises(ValueError, match="adopt"):
        loading.load(spark, source, target, TABLE, check)
    assert loading.load(spark, source, target, TABLE, check, adopt=True).rows == 4
    write_batch(named(T1), source.path, "b", 0)
    assert loading.load(spark, source, target, TABLE, check).rows == 2
    assert served(spark, target) == rows(named(T1, T2, T3, T1))


def test_all_tables_load_and_a_failing_one_does_not_stop_the_others(spark, target, paths):
    create_ledger(spark, paths)
    for number, values in enumerate([[payload("a", 4600.0), payload("b", "12.34")], [payload("c", 4100.0)]]):
        batch = ledger.parse(messages(spark, *values, first=10 * number))
        write_ledger_batch(batch.withColumn("created_at", F.lit(T1).cast("timestamp")), number, "s", paths)
    for dimension in ("payment_type", "risk_level"):
        write_batch(history(spark, dimension, ("x", 1, 1, T1)), paths.history(dimension), "s", 0)
    jdbc_append(history(spark, "risk_level", ("y", 1, 1, T1)), target, "risk_metrics_history")
    found = {r.table: r for r in loading.load_all(spark, paths, target)}
    assert {t: r.rows for t, r in found.items()} == {
        "payment_metrics_history": 1, "risk_metrics_history": 0, "city_metrics_history": 0, "transactions": 3, "fraud_alerts": 2,
    }
    assert [t for t, r in found.items() if r.error] == ["risk_metrics_history"]
    tables = serving.payments(spark, paths)
    for name in tables:
        assert rows(jdbc_table(spark, target, name)) == rows(tables[name])

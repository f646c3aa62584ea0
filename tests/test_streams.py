import json
import random
from decimal import Decimal

import pytest
from helpers import ALL_NOW, messages, payload, rows, silver_rows, texts
from pyspark.sql import functions as F

from tidemark import fixtures, journal, schemas, streaming
from tidemark.operators import gold, ledger, silver
from tidemark.session import ROCKSDB, STATE_MEMORY_MB
from tidemark.sources import batch_table, parquet_stream
from tidemark.streaming.ledger import create_ledger, write_ledger_batch
from tidemark.streaming.progress import summarise


def finish(query):
    query.awaitTermination()
    return query


def transactions(count, seed=0):
    rng = random.Random(seed)
    return [
        (
            str(i), round(rng.uniform(10, 5000), 2), rng.choice(["UPI", "CREDIT_CARD", None]),
            rng.choice("abcdefghijklmnopqrstuvwxyz"), rng.choice(["HIGH", "LOW"]),
        )
        for i in range(count)
    ]


def gold_history(spark, paths, dimension):
    return batch_table(spark, paths.history(dimension), schemas.gold(dimension))


def measured(df, dimension):
    return rows(df.select(dimension, "transaction_count", F.round("total_amount", 2), F.round("avg_amount", 4)))


# ---------------------------------------------------------------- bronze and silver


def test_bronze_stream(spark, paths):
    source = messages(spark, payload("a"), payload("b")).select(
        F.col("json_data").cast("binary").alias("value"), *schemas.ARRIVAL.fieldNames()
    )
    source.write.parquet(f"{paths.root}/in")
    stream = parquet_stream(spark, f"{paths.root}/in", schemas.MESSAGES)
    for _ in range(2):
        finish(streaming.bronze_stream(stream, paths, ALL_NOW))
    table = batch_table(spark, paths.bronze, schemas.BRONZE)
    assert rows(table, "json_data", "offset") == [(payload("a"), 0), (payload("b"), 1)]


def test_silver_stream_equals_batch_for_any_split(spark, paths):
    values = [payload(str(i), 500.0 * i, f"2001-02-03T{i:02}:00:00") for i in range(12)] + ["junk", payload("0")]
    random.Random(3).shuffle(values)
    for part in (values[:1], values[1:6], values[6:]):
        fixtures.write_bronze(texts(spark, *part), paths.bronze, 3)
        finish(streaming.silver_stream(spark, paths, ALL_NOW, max_batches=1))
    found = batch_table(spark, paths.silver, schemas.SILVER)
    assert rows(found) == rows(silver.to_silver(texts(spark, *values)))


def test_a_stray_file_is_not_part_of_a_streamed_table(spark, paths, tmp_path):
    fixtures.write_bronze(texts(spark, payload("a")), paths.bronze)
    finish(streaming.silver_stream(spark, paths, ALL_NOW))
    folder = tmp_path / "data" / "silver"
    part = next(folder.glob("**/part-*.parquet"))
    (folder / "stray.parquet").write_bytes(part.read_bytes())
    assert batch_table(spark, paths.silver, schemas.SILVER).count() == 1


# ---------------------------------------------------------------- gold


@pytest.mark.parametrize("dimension", ["payment_type", "risk_level", "city"])
def test_gold_stream_is_cumulative(spark, paths, dimension):
    data = transactions(300)
    seen = []
    for part in (data[:20], data[20:210], data[210:]):
        fixtures.deliver(silver_rows(spark, *part), paths.silver)
        seen += part
        stamp = f"2001-01-01 00:00:{len(seen) % 60:02}"
        finish(streaming.gold_stream(spark, paths, dimension, trigger=ALL_NOW, clock=lambda: stamp))
        history = gold_history(spark, paths, dimension).where(F.col("snapshot_time") == stamp)
        expected = gold.snapshot(silver_rows(spark, *seen), dimension, 20 if dimension == "city" else None)
        assert measured(history, dimension) == measured(expected, dimension)
    assert gold_history(spark, paths, dimension).select("snapshot_time").distinct().count() == 3


def test_gold_stream_one_batch_per_trigger(spark, paths):
    fixtures.deliver(silver_rows(spark, *transactions(60)), paths.silver, 4)
    finish(streaming.gold_stream(spark, paths, "payment_type", trigger=ALL_NOW, max_batches=1))
    snapshots = gold_history(spark, paths, "payment_type").groupBy("snapshot_time").agg(F.sum("transaction_count"))
    totals = [r[1] for r in snapshots.orderBy("snapshot_time").collect()]
    assert len(totals) == 4 and totals == sorted(totals) and totals[-1] == 60


def test_idle_silver_makes_no_snapshot(spark, paths):
    fixtures.deliver(silver_rows(spark, *transactions(5)), paths.silver)
    for _ in range(3):
        finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW))
    assert gold_history(spark, paths, "city").select("snapshot_time").distinct().count() == 1


def test_gold_replay_replaces_its_snapshot(spark, paths, tmp_path):
    """Remove the commit of the last batch, as if the driver had died after writing the snapshot."""
    fixtures.deliver(silver_rows(spark, *transactions(40)), paths.silver, 2)
    finish(streaming.gold_stream(spark, paths, "payment_type", trigger=ALL_NOW, max_batches=1))
    before = rows(gold_history(spark, paths, "payment_type"))
    commits = tmp_path / "checkpoints" / "gold_payment_type_changes" / "commits"
    (commits / "1").unlink()
    (commits / ".1.crc").unlink(missing_ok=True)
    finish(streaming.gold_stream(spark, paths, "payment_type", trigger=ALL_NOW, max_batches=1))
    assert rows(gold_history(spark, paths, "payment_type")) == before


def test_a_new_checkpoint_overwrites_no_history(spark, paths, tmp_path):
    fixtures.deliver(silver_rows(spark, *transactions(5)), paths.silver)
    finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW, clock=lambda: "2001-01-01 00:00:00"))
    (tmp_path / "checkpoints").rename(tmp_path / "checkpoints-before")
    finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW, clock=lambda: "2001-01-02 00:00:00"))
    assert gold_history(spark, paths, "city").select("snapshot_time").distinct().count() == 2


def test_few_state_partitions_whatever_the_session_says(spark, paths):
    fixtures.deliver(silver_rows(spark, *transactions(5)), paths.silver)
    query = finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW, state_partitions=2))
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_streams_start_before_their_input_has_files(spark, paths):
    finish(streaming.silver_stream(spark, paths, ALL_NOW))
    finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW))
    assert gold_history(spark, paths, "city").count() == 0


# ---------------------------------------------------------------- ledger


def run_ledger(spark, paths, **options):
    stream = journal.rows(journal.entries(spark, paths.bronze, "ledger", 1), schemas.BRONZE)
    return finish(streaming.ledger_stream(stream, paths, ALL_NOW, **options))


def written(spark, paths):
    table = batch_table(spark, paths.ledger, schemas.LEDGER)
    alerts = batch_table(spark, paths.alerts, schemas.FRAUD_ALERTS)
    return rows(table, "transaction_id", "amount"), rows(alerts, "transaction_id", "fraud_score")


def test_ledger_stream_across_batches_and_restarts(spark, paths):
    deliveries = [
        [payload("a", 1.0), payload("b", 4600.0), payload("a", 4700.0)],
        [payload("b", 2.0), payload("c", 4100.0), "junk", payload("d", "3.5")],
        [payload("c", 5.0), payload("a", 6.0)],
    ]
    for i, values in enumerate(deliveries):
        fixtures.write_bronze(messages(spark, *values, first=10 * i).coalesce(1), paths.bronze)
        run_ledger(spark, paths)
    assert written(spark, paths) == (
        [(i, Decimal(a)) for i, a in (("a", "1.00"), ("b", "4600.00"), ("c", "4100.00"), ("d", "3.50"))],
        [("b", Decimal("95.00")), ("c", Decimal("80.00"))],
    )


@pytest.mark.parametrize("own", [None, "64"])
def test_state_partitions_share_bounded_memory(spark, paths, monkeypatch, own):
    from tidemark.streaming import ledger as module

    prefix, seen, write = "spark.sql.streaming.stateStore", [], module.write_first_seen
    if own:
        spark.conf.set(f"{prefix}.rocksdb.maxMemoryUsageMB", own)

    def noted(batch, *args):
        conf = batch.sparkSession.conf
        names = ("providerClass", "rocksdb.boundedMemoryUsage", "rocksdb.maxMemoryUsageMB")
        seen.append([conf.get(f"{prefix}.{name}", None) for name in names])
        write(batch, *args)

    monkeypatch.setattr(module, "write_first_seen", noted)
    try:
        fixtures.write_bronze(messages(spark, payload("a", 1.0), payload("b", 2.0)), paths.bronze)
        run_ledger(spark, paths)
    finally:
        spark.conf.unset(f"{prefix}.rocksdb.maxMemoryUsageMB")
    assert seen and all(s == [ROCKSDB, "true", own or str(STATE_MEMORY_MB)] for s in seen)
    assert spark.conf.get(f"{prefix}.rocksdb.boundedMemoryUsage", None) is None


def test_a_trigger_reads_nothing_of_its_own_ledger(spark, paths, monkeypatch):
    """The state knows the ids: a stream that is alone compares with no table."""
    from tidemark.streaming import ledger as module

    read = []
    monkeypatch.setattr(module.ledger, "matching_keys", lambda *args, **options: read.append(args))
    for i in range(3):
        values = [payload("a", 1.0 + i), payload(f"n{i}", 5.0), payload(f"n{i}", 6.0)]
        fixtures.write_bronze(messages(spark, *values, first=10 * i).coalesce(1), paths.bronze)
        query = run_ledger(spark, paths)
    assert not read and query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    assert written(spark, paths)[0] == [("a", Decimal("1.00")), *[(f"n{i}", Decimal("5.00")) for i in range(3)]]


def test_a_stream_with_a_new_checkpoint_knows_what_others_wrote(spark, paths, tmp_path):
    fixtures.write_bronze(messages(spark, payload("a", 1.0), payload("b", 4600.0)).coalesce(1), paths.bronze)
    run_ledger(spark, paths)
    (tmp_path / "checkpoints").rename(tmp_path / "checkpoints-before")
    fixtures.write_bronze(messages(spark, payload("b", 2.0), payload("c", 3.0), first=10).coalesce(1), paths.bronze)
    run_ledger(spark, paths)
    assert written(spark, paths) == (
        [("a", Decimal("1.00")), ("b", Decimal("4600.00")), ("c", Decimal("3.00"))], [("b", Decimal("95.00"))]
    )


def test_ledger_replay_replaces_its_batch(spark, paths, tmp_path):
    for i, values in enumerate(([payload("a", 1.0)], [payload("a", 2.0), payload("b", 4600.0)])):
        fixtures.write_bronze(messages(spark, *values, first=10 * i).coalesce(1), paths.bronze)
        run_ledger(spark, paths)
    before = written(spark, paths)
    commits = tmp_path / "checkpoints" / "ledger_by_id" / "commits"
    (commits / "1").unlink()
    (commits / ".1.crc").unlink(missing_ok=True)
    run_ledger(spark, paths)
    assert written(spark, paths) == before and len(before[0]) == 2


def batch_of(spark, *values, first=0):
    return ledger.parse(messages(spark, *values, first=first)).withColumn("created_at", F.current_timestamp())


def test_ledger_batch_can_be_repeated(spark, paths):
    create_ledger(spark, paths)
    one = batch_of(spark, payload("a", 4600.0), payload("b", 1.0))
    two = batch_of(spark, payload("a", 2.0), payload("c", 4600.0), first=10)
    for batch, number in ((one, 0), (one, 0), (two, 1), (two, 1)):
        write_ledger_batch(batch, number, "s", paths)
    amounts = {"a": "4600.00", "b": "1.00", "c": "4600.00"}
    assert written(spark, paths) == (
        [(i, Decimal(a)) for i, a in amounts.items()],
        [("a", Decimal("95.00")), ("c", Decimal("95.00"))],
    )


def test_no_alert_is_lost_between_the_two_writes(spark, paths, monkeypatch):
    create_ledger(spark, paths)
    batch = batch_of(spark, payload("a", 4600.0))

    def fail(rows):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(ledger, "fraud_alerts", fail)
        with pytest.raises(RuntimeError):
            write_ledger_batch(batch, 0, "s", paths)
    assert written(spark, paths)[1] == []
    write_ledger_batch(batch, 0, "s", paths)
    write_ledger_batch(batch_of(spark, payload("a", 4600.0), first=5), 1, "s", paths)
    assert written(spark, paths) == ([("a", Decimal("4600.00"))], [("a", Decimal("95.00"))])


def test_two_streams_in_turn_share_a_ledger(spark, paths):
    create_ledger(spark, paths)
    write_ledger_batch(batch_of(spark, payload("a", 1.0)), 0, "s", paths)
    write_ledger_batch(batch_of(spark, payload("a", 2.0), payload("b", 3.0)), 0, "t", paths)
    assert written(spark, paths)[0] == [("a", Decimal("1.00")), ("b", Decimal("3.00"))]


@pytest.mark.parametrize("seed, broadcast_bytes", [(1, 10**6), (2, 0)])
def test_ledger_stream_equals_batch_for_random_splits(spark, paths, seed, broadcast_bytes):
    rng = random.Random(seed)
    values = [payload(str(rng.randrange(25)), round(rng.uniform(3900, 4600), 2)) for _ in range(80)]
    cuts = sorted(rng.sample(range(1, 80), 2))
    for start, end in zip([0, *cuts], [*cuts, 80]):
        fixtures.write_bronze(messages(spark, *values[start:end], first=start).coalesce(1), paths.bronze)
        run_ledger(spark, paths, broadcast_bytes=broadcast_bytes)
    nothing = spark.createDataFrame([], "transaction_id string")
    expected = ledger.new_transactions(ledger.parse(messages(spark, *values)), nothing)
    found = batch_table(spark, paths.ledger, schemas.LEDGER)
    looped = {}
    for value in map(json.loads, values):
        looped.setdefault(value["transaction_id"], Decimal(str(value["amount"])))
    assert rows(found, "transaction_id", "amount") == sorted(looped.items(), key=repr)
    columns = ["transaction_id", "amount", "fraud_score", "reason"]
    assert rows(found, *columns) == rows(expected, *columns)


def test_progress_summary():
    progress = {
        "name": "gold", "batchId": 3, "numInputRows": 10, "durationMs": {"triggerExecution": 7},
        "stateOperators": [{"numRowsTotal": 4}],
    }
    assert summarise(progress) == {"query": "gold", "batch": 3, "rows": 10, "milliseconds": 7, "state_rows": 4}

"""Tables of many batches, and streams that learn of them by their inbox."""

import random

import pytest
from helpers import ALL_NOW, payload, rows, silver_rows, texts
from pyspark.sql import functions as F

from tidemark import fixtures, journal, layout, schemas, streaming
from tidemark.operators import gold
from tidemark.plans.maintenance import compact
from tidemark.sinks import append_batch, write_batch
from tidemark.sources import batch_table


def finish(query):
    query.awaitTermination()
    return query


def many_bronze_batches(spark, path, first, count):
    """One message per batch, as a stream would have left them, without announcing them."""
    ids = spark.range(first, first + count, numPartitions=4)
    made = ids.select(
        F.format_string(payload("%d", 10.0).replace('"%d"', '"%1$d"'), "id").alias("json_data"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ARRIVAL.fields],
        F.lit("s").alias("stream"), F.floor(F.col("id") / layout.FOLD).alias("fold"), F.col("id").alias("batch"),
    )
    made.write.mode("append").partitionBy("stream", "fold", "batch").parquet(path)


def silver_ids(spark, paths):
    return sorted(int(r[0]) for r in batch_table(spark, paths.silver, schemas.SILVER).select("transaction_id").collect())


def test_thousands_of_batches_merged_while_read_over_restarts(spark, paths, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "FOLD", 100)
    many_bronze_batches(spark, paths.bronze, 0, 1150)
    assert compact(spark, paths.bronze, schemas.BRONZE) == 11
    many_bronze_batches(spark, paths.bronze, 1150, 900)
    write_batch(batch_table(spark, paths.bronze, schemas.BRONZE).limit(0), paths.bronze, "s", 2050)
    # The first run starts with an entry per merged fold and one per other batch.
    place = tmp_path / "data" / "bronze-inbox" / "reader=silver"
    journal.subscribe(spark, paths.bronze, "silver")
    assert len(list(place.glob("*.json"))) == 11 + (2051 - 1100)
    query = finish(streaming.silver_stream(spark, paths, ALL_NOW, max_batches=400))
    assert silver_ids(spark, paths) == list(range(2050))
    assert len(query.recentProgress) >= 3

    # Merging goes on between and beside triggers; a restart takes what is new, and only that.
    for number in range(2051, 2054):
        new = texts(spark, payload(str(number)))
        fixtures.write_bronze(new, f"{paths.root}/staged-{number}")
        write_batch(batch_table(spark, f"{paths.root}/staged-{number}", schemas.BRONZE), paths.bronze, "s", number)
        compact(spark, paths.bronze, schemas.BRONZE)
        query = finish(streaming.silver_stream(spark, paths, ALL_NOW))
        assert query.lastProgress["numInputRows"] == 1
    assert silver_ids(spark, paths) == [*range(2050), *range(2051, 2054)]
    assert batch_table(spark, paths.bronze, schemas.BRONZE).count() == 2053


def test_entries_of_committed_triggers_are_deleted(spark, paths, tmp_path):
    place = tmp_path / "data" / "bronze-inbox" / "reader=silver"
    for number in range(3):
        fixtures.write_bronze(texts(spark, payload(str(number))), paths.bronze)
        finish(streaming.silver_stream(spark, paths, ALL_NOW))
    # Those of the newest trigger go with the next.
    assert len(list(place.glob("*.json"))) <= 2
    assert silver_ids(spark, paths) == [0, 1, 2]


def test_a_batch_announced_twice_is_taken_once(spark, paths):
    fixtures.write_bronze(texts(spark, payload("1")), paths.bronze)
    finish(streaming.silver_stream(spark, paths, ALL_NOW))
    # The writer died before its commit and repeats the batch.
    again = texts(spark, payload("1"))
    fixtures.write_bronze(again, f"{paths.root}/again")
    write_batch(batch_table(spark, f"{paths.root}/again", schemas.BRONZE), paths.bronze, "loads", 0)
    fixtures.write_bronze(texts(spark, payload("2")), paths.bronze)
    finish(streaming.silver_stream(spark, paths, ALL_NOW))
    assert silver_ids(spark, paths) == [1, 2]


def test_a_subscription_that_was_interrupted_is_completed(spark, paths, tmp_path, monkeypatch):
    for number in range(3):
        fixtures.write_bronze(texts(spark, payload(str(number))), paths.bronze)
    announce, done = journal._announce, []

    def fail(*args):
        if done:
            raise RuntimeError("driver lost")
        done.append(announce(*args))

    with monkeypatch.context() as patched:
        patched.setattr(journal, "_announce", fail)
        with pytest.raises(RuntimeError):
            journal.subscribe(spark, paths.bronze, "silver")
    finish(streaming.silver_stream(spark, paths, ALL_NOW))
    assert silver_ids(spark, paths) == [0, 1, 2]
    journal.unsubscribe(spark, paths.bronze, "silver")
    assert not (tmp_path / "data" / "bronze-inbox" / "reader=silver").exists()


def test_rows_of_files_with_fewer_or_more_columns(spark, paths):
    path = f"{paths.root}/t"
    append_batch(spark.sql("SELECT 'a' AS json_data, timestamp'2001-02-03 04:05:06.789' AS timestamp, 1 AS other"), path)
    append_batch(spark.sql("SELECT CAST(NULL AS STRING) AS json_data, 5L AS offset"), path)
    stream = journal.rows(journal.entries(spark, path, "test"), schemas.BRONZE)
    found = []
    writer = stream.writeStream.foreachBatch(lambda batch, _: found.extend(batch.collect()))
    finish(writer.option("checkpointLocation", f"{paths.root}/c").trigger(**ALL_NOW).start())
    stamp = spark.sql("SELECT timestamp'2001-02-03 04:05:06.789'").first()[0]
    assert sorted([(r["json_data"], r["offset"], r["timestamp"]) for r in found], key=repr) == sorted(
        [("a", None, stamp), (None, 5, None)], key=repr
    )


# ---------------------------------------------------------------- gold


def some(count, seed, values=60):
    rng = random.Random(seed)
    return [
        (str(i), round(rng.uniform(10, 5000), 2), rng.choice(["UPI", None]), f"c{int(rng.paretovariate(0.7)) % values}", rng.choice("HL"))
        for i in range(count)
    ]


@pytest.mark.parametrize("n", [None, 1, 5])
def test_a_snapshot_follows_from_the_one_before_and_the_changes(spark, n):
    """Against the snapshot of everything, for values that come, grow, stand still and tie."""
    seen, before = [], spark.createDataFrame([], schemas.gold("city"))
    for step, size in enumerate((4, 30, 1, 80)):
        new = some(size, step, 12)
        seen += new
        new_cities = {r[3] for r in new}
        whole = gold.metrics_by(silver_rows(spark, *seen), ("city",))
        changed = whole.where(F.col("value").isin(*new_cities))
        snapshot = gold.advance(before, changed, "city", n, f"2001-01-0{step + 1}")
        expected = gold.snapshot(silver_rows(spark, *seen), "city", n, f"2001-01-0{step + 1}")
        assert rows(snapshot, "city", "transaction_count", "snapshot_time") == rows(
            expected, "city", "transaction_count", "snapshot_time"
        )
        before = spark.createDataFrame(snapshot.collect(), schemas.gold("city"))


def test_three_histories_from_one_reading_of_silver(spark, paths):
    parts = [some(size, seed) for seed, size in enumerate((50, 70, 30))]
    seen = []
    for part in parts:
        fixtures.deliver(silver_rows(spark, *part).coalesce(1), paths.silver)
        seen += part
        query = finish(streaming.gold_stream(spark, paths, trigger=ALL_NOW))
        # The file of the new batch is the only input.
        assert query.lastProgress["numInputRows"] == 1
        stamps = set()
        for dimension, n in (("payment_type", None), ("risk_level", None), ("city", 20)):
            history = batch_table(spark, paths.history(dimension), schemas.gold(dimension))
            newest = history.agg(F.max("snapshot_time")).first()[0]
            stamps.add(newest)
            latest = history.where(F.col("snapshot_time") == F.lit(newest))
            expected = gold.snapshot(silver_rows(spark, *seen), dimension, n)
            columns = (dimension, "transaction_count", F.round("total_amount", 2))
            assert rows(latest, *columns) == rows(expected, *columns)
        assert len(stamps) == 1


def test_a_trigger_writes_and_sorts_only_what_changed(spark, paths):
    values = spark.range(300_000, numPartitions=4).select(
        F.format_string("city %06d", "id").alias("city"), F.lit(1.0).alias("amount"), *[
            F.lit(None).cast(schemas.SILVER[c].dataType).alias(c) for c in schemas.SILVER.fieldNames() if c not in ("city", "amount")
        ]
    ).select(schemas.SILVER.fieldNames())
    append_batch(values, paths.silver)
    append_batch(silver_rows(spark, *[(str(i), 1.0, "UPI", f"city {i % 7:06d}", "L") for i in range(30)]), paths.silver)
    query = finish(streaming.gold_stream(spark, paths, "city", trigger=ALL_NOW, max_batches=1))
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 300_000 and state["numRowsUpdated"] == 7
    changes = spark.read.parquet(f"{paths.changes('gold_city')}/*/*/batch=1")
    assert changes.count() == 7
    newest = spark.read.parquet(f"{paths.history('city')}/*/*/batch=1")
    top = rows(newest, "city", "transaction_count")
    assert len(top) == 20 and top[:8] == [*[(f"city {i:06d}", 6 if i < 2 else 5) for i in range(7)], ("city 000007", 1)]


def test_new_batches_without_rows_repeat_the_snapshot(spark, paths):
    fixtures.deliver(silver_rows(spark, *some(5, 1)), paths.silver)
    finish(streaming.gold_stream(spark, paths, trigger=ALL_NOW))
    append_batch(silver_rows(spark, *some(1, 1)).limit(0), paths.silver)
    finish(streaming.gold_stream(spark, paths, trigger=ALL_NOW))
    fixtures.deliver(silver_rows(spark, *some(5, 2)), paths.silver)
    finish(streaming.gold_stream(spark, paths, trigger=ALL_NOW))
    totals = batch_table(spark, paths.history("risk_level"), schemas.gold("risk_level")).groupBy("snapshot_time")
    assert sorted(r[1] for r in totals.agg(F.sum("transaction_count")).collect()) == [5, 5, 10]

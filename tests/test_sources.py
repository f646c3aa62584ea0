from types import SimpleNamespace

import pytest
from helpers import payload, texts

from tidemark import fixtures, schemas
from tidemark.config import Paths
from tidemark.session import scratch_path, settings, shared_folder
from tidemark.sinks import create_table, write_batch
from tidemark.sources import batch_table, kafka_options, kafka_stream, parquet_stream


def test_kafka_options():
    assert kafka_options("k:9092") == {
        "kafka.bootstrap.servers": "k:9092",
        "subscribe": "transactions_raw",
        "startingOffsets": "latest",
    }
    bounded = kafka_options("k:9092", "t", "earliest", max_offsets=5, min_partitions=64)
    assert bounded["startingOffsets"] == "earliest"
    assert bounded["maxOffsetsPerTrigger"] == "5" and bounded["minPartitions"] == "64"
    assert kafka_options("k", extra={"kafka.security.protocol": "SSL"})["kafka.security.protocol"] == "SSL"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_stream(spark, "k:9092")


def test_stream_limits(spark, paths):
    fixtures.write_bronze(texts(spark, payload("a")), paths.bronze)
    for limits in ({"max_files": 1}, {"max_bytes": "1g"}, {}):
        assert parquet_stream(spark, paths.bronze, schemas.BRONZE, **limits).isStreaming


def test_bronze_without_position_reads_with_nulls(spark, paths):
    texts(spark, payload("a")).write.parquet(paths.bronze)
    (row,) = spark.read.schema(schemas.BRONZE).parquet(paths.bronze).collect()
    assert row["json_data"] == payload("a") and row["offset"] is None


def test_batch_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.gold("city")
    create_table(spark, path, schema)
    assert batch_table(spark, path, schema).count() == 0
    row = spark.createDataFrame([("a", 1, 1.0, 1.0, None)], schema)
    write_batch(row, path, "s", 0)
    write_batch(row, path, "s", 0)
    write_batch(row, path, "s", 1)
    write_batch(row, path, "t", 0)
    create_table(spark, path, schema)
    assert batch_table(spark, path, schema).count() == 3
    others = batch_table(spark, path, schema, besides=("s", 0))
    assert others.count() == 2
    plan = others._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


class Session:
    """What ``shared_folder`` asks a session for."""

    def __init__(self, master="yarn", named=None, chosen=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: chosen)


def test_scratch_is_in_the_folder_the_session_names(tmp_path):
    assert shared_folder(Session(named="s3a://b/c/")) == "s3a://b/c"
    assert shared_folder(Session(chosen="hdfs://n/c")) == "hdfs://n/c"
    assert scratch_path(Session(named="s3a://b/c"), "x").startswith("s3a://b/c/x-")
    with pytest.raises(ValueError):
        shared_folder(Session())
    assert "tidemark-" in shared_folder(Session(master="local[2]"))


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_paths():
    paths = Paths("s3a://bucket/root/")
    assert paths.history("city") == "s3a://bucket/root/data/gold/city_metrics_history"
    assert paths.checkpoint("silver") == "s3a://bucket/root/checkpoints/silver"

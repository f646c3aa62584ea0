"""The message stream. The Kafka connector is a package the cluster provides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import TOPIC


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Bronze starts at the latest offsets, the ledger at the earliest; both only on their first start.

    ``max_offsets`` bounds one micro-batch; ``min_partitions`` splits large topic partitions over more tasks.
    ``extra`` takes any other option of the connector, such as those for security.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets,
        "minPartitions": min_partitions,
    }
    given = {name: str(value) for name, value in options.items() if value is not None}
    return {**given, **(extra or {})}


def kafka_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, **options)).load()

from tidemark.sources.files import batch_table, parquet_stream, parquet_table
from tidemark.sources.jdbc import jdbc_high_water_mark, jdbc_recent, jdbc_summary, jdbc_table, jdbc_trend
from tidemark.sources.kafka import kafka_options, kafka_stream

__all__ = [
    "batch_table",
    "jdbc_high_water_mark",
    "jdbc_recent",
    "jdbc_summary",
    "jdbc_table",
    "jdbc_trend",
    "kafka_options",
    "kafka_stream",
    "parquet_stream",
    "parquet_table",
]

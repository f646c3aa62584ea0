"""Which batches of a table its readers have still to read.

A table written batch by batch has an inbox per reader: a folder with one small entry for every batch that the reader has not
taken yet, with the names of the batch's files. Writers add the entry when a batch is complete. A reader is a stream over its
inbox: Spark's file source bounds a trigger, notes in the checkpoint which entries were taken and deletes those of committed
triggers. So a trigger lists what has come since, however many batches the table has, and neither side keeps a
log of the table's files.

Entries are named by stream and batch. An entry written again, by a writer that repeats its newest batch after a crash or by a
subscription that was interrupted, has the name it had before and is taken once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark import layout

ENTRY = StructType([StructField("path", StringType()), StructField("bytes", LongType())])

# Batches that one trigger takes, unless told otherwise.
MAX_BATCHES = 250

READY = "_READY"


def inboxes(path: str) -> str:
    return f"{path}-inbox"


def inbox(path: str, reader: str) -> str:
    return f"{inboxes(path)}/reader={reader}"


def subscribe(spark: SparkSession, path: str, reader: str) -> str:
    """The reader's inbox. A new one gets entries for all there is: one for each merged fold, and for each other batch.

    The folder is made first: what is written from then on is announced by its writer, and what was written before is listed
    here. Both may announce a batch, under one name.
    """
    place = inbox(path, reader)
    if layout.exists(spark, f"{place}/{READY}"):
        return place
    layout.make_folder(spark, place)
    for fold in layout.folds(spark, path):
        if fold.stream == layout.NO_STREAM:
            continue
        if fold.merged:
            merged = layout.merged_path(path, fold.stream, fold.number)
            _announce(spark, place, f"{fold.stream}-fold-{fold.number:012d}", merged)
            continue
        for batch in layout.complete_batches(spark, path, fold):
            _announce(spark, place, _name(fold.stream, batch), layout.batch_path(path, fold.stream, batch))
    layout.write_file(spark, f"{place}/{READY}", b"")
    return place


def unsubscribe(spark: SparkSession, path: str, reader: str) -> None:
    """Ends announcements to a reader that is stopped for good."""
    layout.remove_folder(spark, inbox(path, reader))


def publish(spark: SparkSession, path: str, stream: str, batch: int) -> None:
    """Tells the readers of a table that a batch is complete."""
    for reader in layout.values(spark, inboxes(path), "reader"):
        _announce(spark, inbox(path, reader), _name(stream, batch), layout.batch_path(path, stream, batch))


def _name(stream: str, batch: int) -> str:
    return f"{stream}-{batch:012d}"


def _announce(spark: SparkSession, place: str, name: str, folder: str) -> None:
    files = layout.data_files(spark, folder)
    lines = [json.dumps({"path": f"{folder}/{file}", "bytes": size}) for file, size in files]
    layout.write_file(spark, f"{place}/{name}.json", "\n".join(lines).encode())


def entries(spark: SparkSession, path: str, reader: str, max_batches: int | None = None) -> DataFrame:
    """A stream of the files of batches new to a reader, whole batches to a trigger, oldest first."""
    place = subscribe(spark, path, reader)
    limit = MAX_BATCHES if max_batches is None else max_batches
    source = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", limit).option("cleanSource", "delete")
    return source.json(place)


def taken(spark: SparkSession, batch: DataFrame, schema: StructType) -> DataFrame:
    """Inside ``foreachBatch`` of a stream of entries: the rows of their files, at most a trigger's."""
    files = [entry["path"] for entry in batch.collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def rows(files: DataFrame, schema: StructType) -> DataFrame:
    """A stream of the rows of a stream of entries, for operators with state.

    Files are dealt to the tasks and read as Arrow batches, the wanted columns only. Stores are those that Arrow's file systems
    reach: mounted folders, S3, GCS, HDFS and Azure.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        def place(path):
            scheme, mark, rest = path.partition("://")
            if not mark:
                return path.removeprefix("file:")
            return f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{rest}"

        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = FileSystem.from_uri(place(path))
                with files.open_input_file(name) as source:
                    table = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                    known = [f.name for f in wanted if f.name in table.schema_arrow.names]
                    for part in table.iter_batches(columns=known):
                        columns = [
                            part.column(f.name).cast(f.type) if f.name in known else pa.nulls(len(part), f.type)
                            for f in wanted
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema=wanted)

    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.select("path").mapInArrow(read, schema)

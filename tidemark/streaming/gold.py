"""Silver to histories of cumulative snapshots.

The running count, sum and average per dimension value are streaming state, one row per value. A trigger reads its new batches of
silver once, for all dimensions, and what comes out of the state are the values it changed. They are kept as a table. Since
counts only grow, a value that did not change stands no higher than before: a snapshot follows from the one before it and
the changed values, also if it is a top n.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import journal, layout, schemas
from tidemark.config import DIMENSIONS, TOP_N, Paths
from tidemark.functions.timing import utc
from tidemark.operators import gold
from tidemark.session import settings, state_store
from tidemark.sinks import create_table, write_batch
from tidemark.sources import parquet_table
from tidemark.streaming.identity import query_id


def gold_stream(
    spark: SparkSession,
    paths: Paths,
    dimension: str | Sequence[str] = DIMENSIONS,
    n: int | None = None,
    trigger: dict | None = None,
    clock: Callable[[], datetime | str] | None = None,
    max_batches: int | None = None,
    state_partitions: int = 8,
    preview: int = 0,
) -> StreamingQuery:
    """One snapshot per dimension and micro-batch with new batches; none while silver is idle.

    ``n`` defaults to each dimension's usual limit. Snapshots of a micro-batch carry one time: its own, which a
    replay repeats, unless a ``clock`` is given. The number of state partitions is fixed by the first
    checkpoint; every one costs a state file per trigger, so it is kept small for the few groups there are. The first
    ``preview`` rows of every snapshot are printed.
    """
    dimensions = (dimension,) if isinstance(dimension, str) else tuple(dimension)
    name = "gold" if dimensions == DIMENSIONS else f"gold_{'_'.join(dimensions)}"
    changes = paths.changes(name)
    create_table(spark, changes, schemas.CHANGES)
    for d in dimensions:
        create_table(spark, paths.history(d), schemas.gold(d))

    needed = schemas.only(schemas.SILVER, (*dimensions, "amount"))
    silver = journal.rows(journal.entries(spark, paths.silver, name, max_batches), needed)
    # Counted in passing, for the progress of the query.
    rows = F.count(F.lit(1)).alias("rows")
    measured = gold.stamp(gold.metrics_by(silver.observe("silver", rows), dimensions)).observe("changed", rows)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = query_id(batch)
        # A micro-batch's plan updates the state, so it runs once.
        written = write_batch(batch.select(schemas.CHANGES.fieldNames()), changes, stream, batch_id)
        changed = parquet_table(spark, written, schemas.CHANGES)
        time = clock() if clock is not None else _time(changed)
        for d in dimensions:
            limit = TOP_N.get(d) if n is None else n
            before = _previous(spark, paths.history(d), schemas.gold(d), stream, batch_id)
            snapshot = gold.advance(before, changed, d, limit, time)
            made = write_batch(snapshot.select(schemas.gold(d).fieldNames()), paths.history(d), stream, batch_id)
            if preview:
                parquet_table(spark, made, schemas.gold(d)).orderBy(*gold.by_count(d)).show(preview, truncate=False)

    writer = (
        measured.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", paths.checkpoint(f"{name}_changes"))
        .queryName(name)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    with settings(
        spark,
        spark__sql__shuffle__partitions=str(state_partitions),
        # Values are free text: state outside the heap, with changes only in each trigger's files.
        **state_store(spark),
    ):
        return writer.start()


def _time(changed: DataFrame) -> datetime:
    """The micro-batch's time. New batches without a row change nothing and tell no time."""
    return utc(changed.agg(F.max(F.unix_micros("snapshot_time")).alias("micros")).first()["micros"]) or datetime.now(UTC)


def _previous(spark: SparkSession, history: str, schema, stream: str, batch: int) -> DataFrame:
    """The snapshot that this query wrote before. Micro-batches are numbered without gaps."""
    if batch == 0:
        return spark.createDataFrame([], schema)
    path = layout.batch_path(history, stream, batch - 1)
    if not layout.exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"{path} is missing; start the query with a new checkpoint")
    return parquet_table(spark, path, schema)

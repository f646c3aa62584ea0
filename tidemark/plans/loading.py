"""Tables of batches to the serving database by journal: whatever is new, whatever its time.

A load is a reader of the table's inbox (``journal``), so a pass opens the files of batches that no pass has loaded, and no
others. Rows go by many writers into a staging table; then the database itself, in one transaction, takes them over and notes
the load in its own journal of loads. A crash before that leaves the target as it was, and the repeat starts with
a new load; one after it is found in the journal, and the repeat adds nothing.

A writer's task may run twice, for example when its executor is lost after the commit. Its rows carry the number of their part
and of their run. A part is committed whole or not at all, so the first run of every part is all of the load.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark import journal, schemas
from tidemark.config import ALERTS_TABLE, DIMENSIONS, HISTORY_TABLES, TRANSACTIONS_TABLE, JdbcTarget, Paths
from tidemark.operators.ledger import KEY
from tidemark.operators.snapshots import TIME
from tidemark.sinks.jdbc import connection, execute, jdbc_append, table_exists
from tidemark.sources.jdbc import quoted
from tidemark.streaming.identity import query_id

log = logging.getLogger("tidemark.serving")

# The journal of loads, in the database.
LOADS = "tidemark_loads"

LOAD, PART, RUN = "load_id", "load_part", "load_run"
MARKS = StructType([StructField(LOAD, StringType()), StructField(PART, LongType()), StructField(RUN, LongType())])

# Connections that write at once.
WRITERS = 8


@dataclass
class LoadResult:
    table: str
    files: int = 0
    rows: int = 0
    error: str | None = None


@dataclass(frozen=True)
class Source:
    """A table of batches, and the columns that tell its rows apart."""

    path: str
    schema: StructType
    key: tuple[str, ...]


def sources(paths: Paths) -> dict[str, Source]:
    """All tables that are served, by the name of their serving table."""
    found = {HISTORY_TABLES[d]: Source(paths.history(d), schemas.gold(d), (TIME, d)) for d in DIMENSIONS}
    found[TRANSACTIONS_TABLE] = Source(paths.ledger, schemas.TRANSACTIONS, (KEY,))
    found[ALERTS_TABLE] = Source(paths.alerts, schemas.FRAUD_ALERTS, (KEY,))
    return found


def load(
    spark: SparkSession,
    source: Source,
    target: JdbcTarget,
    table: str,
    checkpoint: str,
    adopt: bool = False,
    writers: int = WRITERS,
    max_batches: int | None = None,
) -> LoadResult:
    """Appends the batches of a table that no earlier load took, and creates the serving table if there is none.

    A serving table that holds rows but has no journal was filled otherwise. It is refused, unless ``adopt`` says that rows
    whose key it holds are there already. A null in a key equals a null.
    """
    prepare(spark, source.schema, target, table, adopt)
    result = LoadResult(table)

    def write(batch: DataFrame, batch_id: int) -> None:
        files = batch.count()
        rows = journal.taken(batch.sparkSession, batch, source.schema)
        query = query_id(batch)
        load_id = uuid.uuid4().hex
        if not _noted(spark, target, table, query, batch_id):
            stage(rows, target, table, load_id, writers)
            result.rows += take_over(
                spark, target, table, source.schema.fieldNames(), load_id, query, batch_id, source.key if adopt else ()
            )
        result.files += files

    (
        journal.entries(spark, source.path, f"serving-{table}", max_batches)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(f"load_{table}")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return result


def load_all(
    spark: SparkSession, paths: Paths, target: JdbcTarget, adopt: bool = False, writers: int = WRITERS
) -> list[LoadResult]:
    """One pass over all served tables; a failing table does not keep the others from loading."""
    results = []
    for table, source in sources(paths).items():
        try:
            results.append(load(spark, source, target, table, paths.checkpoint(f"load_{table}"), adopt, writers))
        except Exception as error:  # noqa: BLE001 - reported per table
            log.exception("load of %s failed", table)
            results.append(LoadResult(table, error=str(error)))
    return results


def staging(table: str) -> str:
    return f"{table}_staging"


def prepare(spark: SparkSession, schema: StructType, target: JdbcTarget, table: str, adopt: bool = False) -> None:
    """Makes the serving table, its staging table and the journal of loads where they are missing."""
    if not table_exists(spark, target, table):
        jdbc_append(spark.createDataFrame([], schema), target, table)
    with connection(spark, target) as database:
        if not table_exists(spark, target, LOADS):
            key = "table_name VARCHAR(128) NOT NULL, query_id VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL"
            names = "table_name, query_id, batch_id"
            execute(database, f"CREATE TABLE {LOADS} ({key}, n_rows BIGINT, PRIMARY KEY ({names}))")
        known = execute(database, f"SELECT COUNT(*) FROM {LOADS} WHERE table_name = ?", table)
        if not known and not adopt and execute(database, f"SELECT COUNT(*) FROM {table}"):
            raise ValueError(f"{table} holds rows that no load has noted; load with adopt, or into an empty table")
        if not table_exists(spark, target, staging(table)):
            # The types are those of the serving table.
            names = ", ".join(quoted(target, c) for c in schema.fieldNames())
            none = "WHERE 1 = 0" if target.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else "WITH NO DATA"
            execute(database, f"CREATE TABLE {staging(table)} AS SELECT {names} FROM {table} {none}")
            for name, kind in ((LOAD, "VARCHAR(64)"), (PART, "BIGINT"), (RUN, "BIGINT")):
                execute(database, f"ALTER TABLE {staging(table)} ADD COLUMN {quoted(target, name)} {kind}")


def stage(rows: DataFrame, target: JdbcTarget, table: str, load_id: str, writers: int = WRITERS) -> None:
    """Writes rows to the staging table, a transaction per task. ``rows`` must be the same in a task that runs again.

    A scan of files is; it is not shuffled on its way.
    """
    added = schemas.extend(rows.schema, MARKS)

    def marked(batches):
        task = TaskContext.get()
        for batch in batches:
            values = ((load_id, pa.string()), (task.partitionId(), pa.int64()), (task.taskAttemptId(), pa.int64()))
            marks = [pa.array([value] * batch.num_rows, kind) for value, kind in values]
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks], [*batch.schema.names, LOAD, PART, RUN])

    rows.mapInArrow(marked, added).write.option("numPartitions", writers).jdbc(
        target.url, staging(table), mode="append", properties=target.properties
    )


def _noted(spark: SparkSession, target: JdbcTarget, table: str, query: str, batch_id: int) -> bool:
    mine = f"SELECT COUNT(*) FROM {LOADS} WHERE table_name = ? AND query_id = ? AND batch_id = ?"
    with connection(spark, target) as database:
        return bool(execute(database, mine, table, query, batch_id))


def take_over(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    columns: Sequence[str],
    load_id: str,
    query: str,
    batch_id: int,
    key: Sequence[str] = (),
) -> int:
    """One transaction: the rows of a load from the staging table to the serving table, and the note of it; gives their number."""
    load_, part, run = (quoted(target, c) for c in (LOAD, PART, RUN))
    names = [quoted(target, c) for c in columns]
    chosen = ", ".join(f"s.{c}" for c in names)
    first = f"SELECT {part} AS p, MIN({run}) AS r FROM {staging(table)} WHERE {load_} = ? GROUP BY {part}"
    insert = (
        f"INSERT INTO {table} ({', '.join(names)}) SELECT {chosen} FROM {staging(table)} s "
        f"JOIN ({first}) f ON s.{part} = f.p AND s.{run} = f.r WHERE s.{load_} = ?"
    )
    if key:
        same = (f"(t.{c} = s.{c} OR (t.{c} IS NULL AND s.{c} IS NULL))" for c in (quoted(target, k) for k in key))
        insert += f" AND NOT EXISTS (SELECT 1 FROM {table} t WHERE {' AND '.join(same)})"
    with connection(spark, target, transaction=True) as database:
        rows = execute(database, insert, load_id, load_id)
        execute(database, f"INSERT INTO {LOADS} VALUES (?, ?, ?, ?)", table, query, batch_id, rows)
        # Also what failed loads have left. A task of theirs that still runs leaves rows that no later load takes.
        execute(database, f"DELETE FROM {staging(table)}")
    return rows

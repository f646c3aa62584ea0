"""One command per job: ``python -m tidemark <job> --root <shared folder>``."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import DIMENSIONS, HISTORY_TABLES, TOPIC, JdbcTarget, Paths
from tidemark.journal import MAX_BATCHES
from tidemark.operators import monitor
from tidemark.operators.snapshots import TIME
from tidemark.operators.bronze import to_bronze
from tidemark.plans import dashboard, loading, maintenance, serving
from tidemark.session import build_session
from tidemark.sources import jdbc_recent, kafka_stream
from tidemark.streaming import ProgressLog, bronze_stream, gold_stream, ledger_stream, rejects_stream, silver_stream


def _trigger(args) -> dict | None:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def _messages(spark: SparkSession, args, starting_offsets: str) -> DataFrame:
    return kafka_stream(
        spark,
        args.servers,
        topic=args.topic,
        starting_offsets=args.starting_offsets or starting_offsets,
        max_offsets=args.max_offsets,
        extra=dict(option.split("=", 1) for option in args.option),
    )


def _limits(args) -> dict:
    return {"max_batches": args.max_batches}


def _served(args) -> JdbcTarget | None:
    """The serving database, when one is configured and wanted."""
    return None if args.lake or "TIDEMARK_JDBC_URL" not in os.environ else JdbcTarget.from_env()


def _table_report(spark: SparkSession, args) -> DataFrame:
    target = _served(args)
    if target is None:
        return monitor.table_report(serving.histories(spark, Paths(args.root)))
    return serving.table_report(spark, target)


def run_bronze(spark, args):
    return [bronze_stream(_messages(spark, args, "latest"), Paths(args.root), _trigger(args))]


def run_silver(spark, args):
    paths, trigger, limits = Paths(args.root), _trigger(args), _limits(args)
    streams = [silver_stream(spark, paths, trigger, **limits)]
    return [*streams, rejects_stream(spark, paths, trigger, **limits)] if args.rejects else streams


def run_gold(spark, args):
    limits, dimensions = _limits(args), args.dimension or DIMENSIONS
    return [gold_stream(spark, Paths(args.root), dimensions, trigger=_trigger(args), preview=args.preview, **limits)]


def run_ledger(spark, args):
    messages = to_bronze(_messages(spark, args, "earliest"))
    return [ledger_stream(messages, Paths(args.root), _trigger(args))]


def _report(results) -> None:
    for result in results:
        left_out = f", {result.untimed} without a time left out" if result.untimed else ""
        error = f" ({result.error})" if result.error else ""
        print(f"{result.table}: {result.rows} rows after {result.mark}{left_out}{error}")
    if any(result.error for result in results):
        raise SystemExit(1)


def _served_tables(spark, args) -> dict[str, DataFrame]:
    paths = Paths(args.root)
    return serving.histories(spark, paths) | serving.payments(spark, paths)


def run_sync(spark, args):
    _report(serving.sync_all(spark, _served_tables(spark, args), JdbcTarget.from_env()))


def run_backfill(spark, args):
    _report(serving.sync_all(spark, _served_tables(spark, args), JdbcTarget.from_env(), load=serving.backfill))


def run_load(spark, args):
    results = loading.load_all(spark, Paths(args.root), JdbcTarget.from_env(), args.adopt, args.writers)
    for result in results:
        print(f"{result.table}: {result.rows} rows of {result.files} files{f' ({result.error})' if result.error else ''}")
    if any(result.error for result in results):
        raise SystemExit(1)


def run_compact(spark, args):
    paths = Paths(args.root)
    tables = {paths.history(d): schemas.gold(d) for d in DIMENSIONS}
    tables |= {paths.ledger: schemas.LEDGER, paths.alerts: schemas.FRAUD_ALERTS}
    tables |= {paths.bronze: schemas.BRONZE, paths.silver: schemas.SILVER, paths.rejects: schemas.REJECTS}
    tables |= {paths.changes(query): schemas.CHANGES for query in ("gold", *(f"gold_{d}" for d in DIMENSIONS))}
    for path, schema in tables.items():
        print(f"{path}: {maintenance.compact(spark, path, schema)} folds merged")


def run_health(spark, args):
    checked = monitor.freshness(_table_report(spark, args), args.as_of, args.stale_after)
    checked.show(truncate=False)
    monitor.assert_fresh(checked, list(HISTORY_TABLES.values()))


def run_report(spark, args):
    _table_report(spark, args).show(truncate=False)


def run_dashboard(spark, args):
    target, trends = _served(args), None
    if target is None:
        recent = serving.histories(spark, Paths(args.root))
    else:
        recent = {name: jdbc_recent(spark, target, name) for name in HISTORY_TABLES.values()}
        trends = dashboard.served_trends(spark, target)
    for name, frame in dashboard.frames(recent, trends).items():
        if args.out:
            frame.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            _print_newest(name, frame, args.last)


def _print_newest(name: str, frame: DataFrame, last: int) -> None:
    """All rows of a frame, or of a long trend the newest; the heading says how many there are."""
    rows = frame.count()
    if TIME in frame.columns and rows > last:
        print(f"{name}: the newest {last} of {rows} rows")
        frame = frame.orderBy(F.desc(TIME))
        rows = last
    else:
        print(f"{name}: {rows} rows")
    frame.show(rows, truncate=False, vertical=name == "summary")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark")
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, run, every: str | None = None) -> argparse.ArgumentParser:
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--root", required=True, help="folder of the tables and checkpoints")
        if name in ("bronze", "silver", "gold", "ledger"):
            command.add_argument("--every", default=every, help="trigger interval, such as '1 minute'")
            command.add_argument("--once", action="store_true", help="process what there is, then stop")
        if name in ("bronze", "ledger"):
            command.add_argument("--servers", required=True)
            command.add_argument("--topic", default=TOPIC)
            command.add_argument("--starting-offsets")
            command.add_argument("--max-offsets", type=int)
            command.add_argument("--option", action="append", default=[], help="a connector option, NAME=VALUE")
        if name in ("silver", "gold"):
            command.add_argument("--max-batches", type=int, help=f"batches per trigger, {MAX_BATCHES} if not given")
        if name in ("health", "report", "dashboard"):
            command.add_argument("--lake", action="store_true", help="read the lake even if a database is set")
        return command

    job("bronze", run_bronze)
    job("silver", run_silver).add_argument("--rejects", action="store_true", help="also keep the messages left out")
    gold = job("gold", run_gold, every="1 minute")
    gold.add_argument("--dimension", choices=DIMENSIONS)
    gold.add_argument("--preview", type=int, default=0, help="rows of every snapshot to print")
    job("ledger", run_ledger)
    job("sync", run_sync)
    job("backfill", run_backfill)
    load = job("load", run_load)
    load.add_argument("--adopt", action="store_true", help="the tables hold rows of sync or backfill; leave out keys they have")
    load.add_argument("--writers", type=int, default=loading.WRITERS, help="connections that write at once")
    job("compact", run_compact)
    health = job("health", run_health)
    health.add_argument("--as-of")
    health.add_argument("--stale-after", type=float, default=10)
    job("report", run_report)
    shown = job("dashboard", run_dashboard)
    shown.add_argument("--out", help="folder for the whole frames as Parquet, instead of printing")
    shown.add_argument("--last", type=int, default=20, help="snapshots of a trend to print, the newest first")
    return root


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    args = parser().parse_args(arguments)
    spark = build_session(f"tidemark-{args.job}")
    spark.streams.addListener(ProgressLog())
    await_all(spark, args.run(spark, args) or [])


def await_all(spark: SparkSession, queries: list) -> None:
    """Waits until all queries have ended. If one fails, the others are stopped and its error is raised."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
            _raise_failure(queries)
        _raise_failure(queries)
    finally:
        for query in queries:
            query.stop()


def _raise_failure(queries: list) -> None:
    for query in queries:
        if query.exception() is not None:
            raise query.exception()

"""

Values are made comparable at this boundary only: sums are rounded, timestamps become zoneless,
decimals become doubles. Streams run over all input with ``availableNow`` and are read back.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures, journal, schemas, streaming
from tidemark.config import Paths
from tidemark.functions import formatting, parsing
from tidemark.operators import bronze, gold, kpi, ledger, monitor, silver, snapshots
from tidemark.plans import serving
from tidemark.session import scratch_path
from tidemark.sources import batch_table, parquet_stream

FLAGSHIP_DIR = "/root/testdata/sf0.001"

SNAPSHOT = "2002-01-01 00:00:00"
AS_OF_FRESH = "2002-01-01 00:10:00"
AS_OF_STALE = "2002-01-01 00:10:01"
MARK = "1998-01-01 00:00:00"
ALL_NOW = {"availableNow": True}
# Small, so that a load has several parts.
ROWS_PER_LOAD = 5
# Transactions before this time reach silver first; batches of each part are read one per trigger.
SPLIT = "1997-01-01 00:00:00"
BATCHES = 2
STAMPS = ("2001-01-01 00:00:00", "2001-01-02 00:00:00", "2001-01-03 00:00:00", SNAPSHOT)


# ---------------------------------------------------------------- inputs


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fixtures.with_instants(fixtures.transactions(spark, sf_dir))
    return silver.add_features(tx)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.json_messages(fixtures.transactions(spark, sf_dir))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.damaged(fixtures.transactions(spark, sf_dir))


def _delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and repeated messages, typed."""
    return fixtures.with_repeats(fixtures.delivered(fixtures.transactions(spark, sf_dir)))


def _histories(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = fixtures.histories(spark, sf_dir, "payment_type", "risk_level", "city")
    return dict(zip(("payment_metrics_history", "risk_metrics_history", "city_metrics_history"), frames))


# ---------------------------------------------------------------- outputs


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, decimals as doubles, metrics rounded."""
    rounding = {"total_amount": 2, "avg_amount": 4}
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(name)
        if dtype == "timestamp":
            column = column.cast("timestamp_ntz")
        elif dtype.startswith("decimal"):
            column = column.cast("double")
        elif name in rounding:
            column = F.round(column, rounding[name])
        elif dtype == "int":
            column = column.cast("bigint")
        columns.append(column.alias(name))
    return df.select(*columns)


# ---------------------------------------------------------------- batch queries


def _silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    refined = silver.to_silver(_bronze(spark, sf_dir))
    return refined.select("transaction_id", "is_high_value", "is_night_transaction", "risk_level")


def _fraud_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ledger.score(ledger.parse(_bronze(spark, sf_dir)))
    return scored.select("transaction_id", "is_fraud", "fraud_score", "reason")


def _new_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = fixtures.already_in_ledger(fixtures.transactions(spark, sf_dir)).select("transaction_id")
    return ledger.new_transactions(_delivery(spark, sf_dir), known, created_at=SNAPSHOT)


def _gold(dimension: str, n: int | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.snapshot(_silver(spark, sf_dir), dimension, n, SNAPSHOT)

    return query


def _on_history(dimension: str, operator):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        (history,) = fixtures.histories(spark, sf_dir, dimension)
        return operator(history)

    return query


def _on_histories(operator):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*_histories(spark, sf_dir).values())

    return query


def _on_tables(operator):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(_histories(spark, sf_dir))

    return query


def _served(history: DataFrame) -> DataFrame:
    """What a target holds that was last synchronised at MARK."""
    return history.where(F.col("snapshot_time") <= F.lit(MARK).cast("timestamp"))


def _loaded(history: DataFrame, mark: str | None) -> DataFrame:
    """What the serving jobs append to a target with this newest time, all transactions of it together."""
    load = serving.pending(history, mark, rows_per_transaction=ROWS_PER_LOAD, with_untimed=mark is None)
    return reduce(DataFrame.unionByName, load.parts)


def _currency_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every amount in units, thousands and millions, and as a loss."""
    tx = fixtures.transactions(spark, sf_dir)
    amount = F.col("amount")
    return tx.select(
        "transaction_id",
        formatting.currency(amount / 8).alias("eighth_text"),
        formatting.currency(amount * 1000).alias("thousandfold_text"),
        formatting.currency(-amount).alias("loss_text"),
        formatting.grouped_integer(amount * 1000).alias("count_text"),
    )


# ---------------------------------------------------------------- streaming queries


def _finish(query) -> None:
    query.awaitTermination()


def _bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = Paths(scratch_path(spark, "bronze-stream"))
    sent = fixtures.delivered(fixtures.transactions(spark, sf_dir))
    messages = fixtures.json_messages(sent, *schemas.ARRIVAL.fieldNames())
    messages.select(
        F.col("json_data").cast("binary").alias("value"), *schemas.ARRIVAL.fieldNames()
    ).write.parquet(f"{paths.root}/messages")
    arriving = parquet_stream(spark, f"{paths.root}/messages", schemas.MESSAGES)
    _finish(streaming.bronze_stream(arriving, paths, ALL_NOW))
    table = batch_table(spark, paths.bronze, schemas.BRONZE)
    fields = table.select("partition", parsing.json_fields("json_data", schemas.PAYLOAD))
    return fields.select("transaction_id", "amount", "city", "partition")


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = Paths(scratch_path(spark, "silver-stream"))
    fixtures.write_bronze(_bronze(spark, sf_dir), paths.bronze, BATCHES)
    _finish(streaming.silver_stream(spark, paths, ALL_NOW, max_batches=1))
    return batch_table(spark, paths.silver, schemas.SILVER)


def _gold_stream(dimension: str, at: str = SNAPSHOT):
    """The snapshot of a time in a history of four triggers, over a restart."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = Paths(scratch_path(spark, "gold-stream"))
        rows, stamps = _silver(spark, sf_dir), iter(STAMPS)
        early = F.col("transaction_timestamp") < F.lit(SPLIT).cast("timestamp")
        for part in (early, ~early):
            fixtures.deliver(rows.where(part), paths.silver, BATCHES)
            stream = streaming.gold_stream(
                spark, paths, dimension, trigger=ALL_NOW, clock=lambda: next(stamps), max_batches=1
            )
            _finish(stream)
        history = batch_table(spark, paths.history(dimension), schemas.gold(dimension))
        if at == SNAPSHOT:
            return snapshots.latest_snapshot(history)
        return history.where(F.col("snapshot_time") == F.lit(at).cast("timestamp"))

    return query


def _ledger_run(spark: SparkSession, sf_dir: str) -> Paths:
    """Two runs of the ledger stream: the messages, then repeats of some of them."""
    paths = Paths(scratch_path(spark, "ledger-stream"))
    sent = fixtures.delivered(fixtures.transactions(spark, sf_dir))
    for delivery in (sent, fixtures.repeated(sent)):
        messages = fixtures.json_messages(delivery, *schemas.ARRIVAL.fieldNames())
        fixtures.write_bronze(messages, paths.bronze)
        arriving = journal.rows(journal.entries(spark, paths.bronze, "ledger"), schemas.BRONZE)
        _finish(streaming.ledger_stream(arriving, paths, ALL_NOW))
    return paths


def _ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _ledger_run(spark, sf_dir)
    return ledger.transactions(batch_table(spark, paths.ledger, schemas.LEDGER)).drop("created_at")


def _alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _ledger_run(spark, sf_dir)
    return batch_table(spark, paths.alerts, schemas.FRAUD_ALERTS).drop("created_at")


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """JSON messages to silver to the payment metrics."""
    return _prepared(
        lambda spark, sf_dir: gold.snapshot(
            silver.to_silver(_bronze(spark, sf_dir)), "payment_type", snapshot_time=SNAPSHOT
        )
    )(spark, FLAGSHIP_DIR)


def _corpus_queries():
    """The module of corpus queries, or None where the subpackage is not installed."""
    try:
        return importlib.import_module("tidemark.llm.queries")
    except ModuleNotFoundError as missing:
        if missing.name not in ("tidemark.llm", "tidemark.llm.queries", "corpus_pipeline"):
            raise
        return None


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The layers' wall clocks are in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(query(spark, sf_dir.rstrip("/")))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = _corpus_queries()
    return payment_queries() | (corpus.queries() if corpus else {})


def payment_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "bronze_messages": lambda spark, sf_dir: bronze.to_bronze(
            _bronze(spark, sf_dir).select(F.col("json_data").cast("binary").alias("value"))
        ),
        "silver_parse": lambda spark, sf_dir: silver.valid(silver.parse(_bronze(spark, sf_dir))),
        "silver_features": _silver_features,
        "silver_rejects": lambda spark, sf_dir: silver.reject_counts(_damaged(spark, sf_dir)),
        "fraud_score": _fraud_score,
        "ledger_new_transactions": lambda spark, sf_dir: ledger.transactions(_new_entries(spark, sf_dir)),
        "fraud_alerts": lambda spark, sf_dir: ledger.fraud_alerts(_new_entries(spark, sf_dir)),
        "gold_payment_metrics": _gold("payment_type"),
        "gold_risk_metrics": _gold("risk_level"),
        "gold_city_metrics": _gold("city", 20),
        "row_count": lambda spark, sf_dir: gold.row_count(_silver(spark, sf_dir)),
        "latest_snapshot_payment": _on_history("payment_type", snapshots.latest_snapshot),
        "latest_snapshot_risk": _on_history("risk_level", snapshots.latest_snapshot),
        "latest_snapshot_city": _on_history("city", snapshots.latest_snapshot),
        "previous_snapshot_payment": _on_history("payment_type", snapshots.previous_snapshot),
        "previous_snapshot_risk": _on_history("risk_level", snapshots.previous_snapshot),
        "revenue_trend": _on_history("payment_type", _rounded(kpi.revenue_trend, "revenue")),
        "transaction_trend": _on_history("payment_type", kpi.transaction_trend),
        "high_risk_trend": _on_history("risk_level", kpi.high_risk_trend),
        "payment_distribution": _on_history("payment_type", kpi.payment_distribution),
        "risk_distribution": _on_history("risk_level", _rounded(kpi.risk_distribution, "share", places=6)),
        "top_cities": _on_history("city", kpi.top_cities),
        "kpi_summary": _on_histories(
            _rounded(kpi.summary, "total_revenue", "previous_revenue", "revenue_delta")
        ),
        "dimension_counts": _on_histories(kpi.dimension_counts),
        "currency_text": _currency_text,
        "high_water_mark": _on_history("payment_type", lambda df: snapshots.high_water_mark(_served(df))),
        "incremental_new_rows": _on_history("payment_type", lambda df: _loaded(df, MARK)),
        "backfill_rows": _on_history("city", lambda df: _loaded(df, None)),
        "freshness": _on_tables(lambda tables: monitor.freshness(monitor.table_report(tables), AS_OF_FRESH)),
        "freshness_stale": _on_tables(lambda tables: monitor.freshness(monitor.table_report(tables), AS_OF_STALE)),
        "table_report": _on_tables(monitor.table_report),
        "bronze_stream": _bronze_stream,
        "silver_stream": _silver_stream,
        "gold_stream_payment": _gold_stream("payment_type"),
        "gold_stream_risk": _gold_stream("risk_level"),
        "gold_stream_city": _gold_stream("city"),
        "gold_stream_before_restart": _gold_stream("payment_type", STAMPS[BATCHES - 1]),
        "ledger_stream": _ledger_stream,
        "alert_stream": _alert_stream,
    }
    return {name: _prepared(query) for name, query in found.items()}


def _rounded(operator, *names: str, places: int = 2):
    """An operator with some result columns rounded."""

    def run(*frames: DataFrame) -> DataFrame:
        return operator(*frames).withColumns({name: F.round(name, places) for name in names})

    return run


# ---------------------------------------------------------------- oracles

_TX = """
tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(100 + o_orderkey % 900 AS VARCHAR) AS merchant_id,
         floor(o_totalprice) / CAST(100 AS DOUBLE) AS amount,
         CASE o_orderkey % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CREDIT_CARD'
                             WHEN 2 THEN 'DEBIT_CARD' ELSE 'NET_BANKING' END AS payment_type,
         n_name AS city,
         o_orderdate + CAST((o_orderkey * 7) % 24 AS INT) * INTERVAL '1' HOUR AS transaction_timestamp
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_SILVER = (
    _TX
    + """,
silver AS (
  SELECT *, amount > 3000 AS is_high_value,
         hour(transaction_timestamp) BETWEEN 0 AND 6 AS is_night_transaction,
         CASE WHEN amount > 4000 THEN 'HIGH' WHEN amount > 2000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM tx
)"""
)

_SCORED = """
scored AS (
  SELECT *, fraud_score > 0 AS is_fraud,
         CASE fraud_score WHEN 95 THEN 'Suspicious Very High Amount'
                          WHEN 80 THEN 'High Amount Transaction'
                          WHEN 70 THEN 'Transaction During Unusual Hours' END AS reason
  FROM (SELECT *, CAST(CASE WHEN amount > 4500 THEN 95 WHEN amount > 4000 THEN 80
                            WHEN hour(transaction_timestamp) BETWEEN 0 AND 4 THEN 70
                            ELSE 0 END AS BIGINT) AS fraud_score
        FROM {source})
)"""

# Messages and later copies; of each id the first one counts, unless the ledger holds it already.
_NEW = f"""{_TX},
delivery AS (
  SELECT *, transaction_timestamp AS arrived FROM tx
  UNION ALL BY NAME
  SELECT * REPLACE (amount + 1.0 AS amount), transaction_timestamp + INTERVAL '20' YEAR AS arrived
  FROM tx WHERE payment_type = 'UPI'
),
fresh AS (
  SELECT * FROM delivery
  WHERE transaction_id NOT IN (SELECT transaction_id FROM tx
                               WHERE transaction_timestamp < TIMESTAMP '1997-01-01 00:00:00')
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY arrived) = 1
),{_SCORED.format(source="fresh")}"""


def _metrics(dimension: str, tail: str = "") -> str:
    return f"""
SELECT {dimension}, count(*) AS transaction_count, round(sum(amount), 2) AS total_amount,
       round(avg(amount), 4) AS avg_amount, TIMESTAMP '{SNAPSHOT}' AS snapshot_time
FROM silver GROUP BY {dimension} {tail}"""


_TOP_20 = "ORDER BY transaction_count DESC, city ASC NULLS LAST LIMIT 20"


_TOP_20_PER_SNAPSHOT = """
  QUALIFY row_number() OVER (PARTITION BY snapshot_time
                             ORDER BY count(*) DESC, city ASC NULLS LAST) <= 20"""


def _history_cte(name: str, dimension: str) -> str:
    top = _TOP_20_PER_SNAPSHOT if dimension == "city" else ""
    return f"""
{name} AS (
  SELECT {dimension}, count(*) AS transaction_count, round(sum(amount), 2) AS total_amount,
         round(sum(amount) / count(*), 4) AS avg_amount, snapshot_time
  FROM silver JOIN (SELECT unnest([TIMESTAMP '1996-01-01 00:00:00', TIMESTAMP '1998-01-01 00:00:00',
                                   TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2002-01-01 00:00:00'])
                           AS snapshot_time)
       ON transaction_timestamp < snapshot_time
  GROUP BY {dimension}, snapshot_time {top}
)"""


_PAYMENTS = f"WITH {_SILVER},{_history_cte('payments', 'payment_type')}"
_RISKS = f"WITH {_SILVER},{_history_cte('risks', 'risk_level')}"
_CITIES = f"WITH {_SILVER},{_history_cte('cities', 'city')}"
_ALL = f"{_PAYMENTS},{_history_cte('risks', 'risk_level')},{_history_cte('cities', 'city')}"


def _latest(table: str) -> str:
    return f"(SELECT max(snapshot_time) FROM {table})"


def _previous(table: str) -> str:
    return f"(SELECT max(snapshot_time) FROM {table} WHERE snapshot_time < {_latest(table)})"


def _over_tables(select: str) -> str:
    names = ("payments", "risks", "cities")
    tables = ("payment_metrics_history", "risk_metrics_history", "city_metrics_history")
    return " UNION ALL ".join(
        select.format(name=table, table=name) for name, table in zip(names, tables)
    )


def _freshness_sql(as_of: str) -> str:
    rows = _over_tables(
        "SELECT '{name}' AS table_name, max(snapshot_time) AS latest_snapshot FROM {table}"
    )
    return f"""{_ALL}
SELECT *, CASE WHEN age_minutes IS NULL THEN 'EMPTY' WHEN age_minutes > 10 THEN 'STALE' ELSE 'OK' END AS status
FROM (SELECT *, (epoch_us(TIMESTAMP '{as_of}') - epoch_us(latest_snapshot)) / 60000000.0::DOUBLE AS age_minutes
      FROM ({rows}))"""


def _currency_sql(value: str) -> str:
    return f"""CASE WHEN {value} >= 1000000 THEN printf('$%.2fM', {value} / 1000000)
     WHEN {value} >= 1000 THEN printf('$%.2fK', {value} / 1000) ELSE printf('$%.2f', {value}) END"""


_SUMMARY_SQL = f"""{_ALL},
p AS (
  SELECT round(coalesce(sum(total_amount) FILTER (snapshot_time = {_latest('payments')}), 0), 2) AS total_revenue,
         round(coalesce(sum(total_amount) FILTER (snapshot_time = {_previous('payments')}), 0), 2) AS previous_revenue,
         CAST(coalesce(sum(transaction_count) FILTER (snapshot_time = {_latest('payments')}), 0) AS BIGINT)
           AS total_transactions,
         CAST(coalesce(sum(transaction_count) FILTER (snapshot_time = {_previous('payments')}), 0) AS BIGINT)
           AS previous_transactions,
         max(snapshot_time) AS last_updated
  FROM payments
),
r AS (
  SELECT CAST(coalesce(sum(transaction_count) FILTER (snapshot_time = {_latest('risks')}), 0) AS BIGINT)
           AS high_risk_transactions,
         CAST(coalesce(sum(transaction_count) FILTER (snapshot_time = {_previous('risks')}), 0) AS BIGINT)
           AS previous_high_risk
  FROM risks WHERE risk_level = 'HIGH'
),
c AS (SELECT count(DISTINCT city) AS cities_covered FROM cities WHERE snapshot_time = {_latest('cities')}),
k AS (
  SELECT *, round(total_revenue - previous_revenue, 2) AS revenue_delta,
         total_transactions - previous_transactions AS transaction_delta,
         high_risk_transactions - previous_high_risk AS high_risk_delta
  FROM p, r, c
)
SELECT *, {_currency_sql('total_revenue')} AS revenue_text, {_currency_sql('revenue_delta')} AS revenue_delta_text,
       format('{{:,}}', total_transactions) AS transactions_text,
       format('{{:,}}', transaction_delta) AS transaction_delta_text,
       format('{{:,}}', high_risk_transactions) AS high_risk_text,
       format('{{:,}}', high_risk_delta) AS high_risk_delta_text
FROM k"""


def oracle_sql() -> dict[str, str]:
    corpus = _corpus_queries()
    return payment_sql() | (corpus.oracle_sql() if corpus else {})


def payment_sql() -> dict[str, str]:
    base = "transaction_id, user_id, merchant_id, amount, payment_type, city, transaction_timestamp"
    entry_columns = base.replace("amount", "CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount")
    alert_columns = "transaction_id, CAST(fraud_score AS DOUBLE) AS fraud_score, reason"
    first_writes = f"WITH {_TX},{_SCORED.format(source='tx')}"
    return {
        "bronze_messages": f"""WITH {_TX}
SELECT '{{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","merchant_id":"' || merchant_id
       || '","amount":' || CAST(amount AS VARCHAR) || ',"payment_type":"' || payment_type || '","city":"' || city
       || '","transaction_timestamp":"' || strftime(transaction_timestamp, '%Y-%m-%dT%H:%M:%S') || '"}}' AS json_data
FROM tx""",
        "silver_rejects": f"""WITH {_TX}
            SELECT CASE CAST(transaction_id AS BIGINT) % 10 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'no id'
                        WHEN 5 THEN 'no message' ELSE 'no amount' END AS reason,
                   count(*) AS n
            FROM tx WHERE CAST(transaction_id AS BIGINT) % 10 BETWEEN 1 AND 5 GROUP BY 1""",
        "silver_parse": f"WITH {_TX} SELECT {base} FROM tx",
        "silver_features": f"""WITH {_SILVER}
SELECT transaction_id, is_high_value, is_night_transaction, risk_level FROM silver""",
        "fraud_score": f"{first_writes} SELECT transaction_id, is_fraud, fraud_score, reason FROM scored",
        "ledger_new_transactions": f"""WITH {_NEW}
SELECT {entry_columns}, TIMESTAMP '{SNAPSHOT}' AS created_at FROM scored""",
        "fraud_alerts": f"""WITH {_NEW}
SELECT {alert_columns}, TIMESTAMP '{SNAPSHOT}' AS created_at FROM scored WHERE is_fraud""",
        "gold_payment_metrics": f"WITH {_SILVER} {_metrics('payment_type')}",
        "gold_risk_metrics": f"WITH {_SILVER} {_metrics('risk_level')}",
        "gold_city_metrics": f"WITH {_SILVER} {_metrics('city', _TOP_20)}",
        "row_count": f"WITH {_SILVER} SELECT count(*) AS n FROM silver",
        "latest_snapshot_payment": f"{_PAYMENTS} SELECT * FROM payments WHERE snapshot_time = {_latest('payments')}",
        "latest_snapshot_risk": f"{_RISKS} SELECT * FROM risks WHERE snapshot_time = {_latest('risks')}",
        "latest_snapshot_city": f"{_CITIES} SELECT * FROM cities WHERE snapshot_time = {_latest('cities')}",
        "previous_snapshot_payment": f"{_PAYMENTS} SELECT * FROM payments WHERE snapshot_time = {_previous('payments')}",
        "previous_snapshot_risk": f"{_RISKS} SELECT * FROM risks WHERE snapshot_time = {_previous('risks')}",
        "revenue_trend": f"""{_PAYMENTS}
SELECT snapshot_time, round(sum(total_amount), 2) AS revenue FROM payments GROUP BY snapshot_time""",
        "transaction_trend": f"""{_PAYMENTS}
SELECT snapshot_time, CAST(sum(transaction_count) AS BIGINT) AS transactions FROM payments GROUP BY snapshot_time""",
        "high_risk_trend": f"{_RISKS} SELECT snapshot_time, transaction_count FROM risks WHERE risk_level = 'HIGH'",
        "payment_distribution": f"""{_PAYMENTS}
SELECT payment_type, transaction_count FROM payments WHERE snapshot_time = {_latest('payments')}""",
        "risk_distribution": f"""{_RISKS}
SELECT risk_level, transaction_count,
       round(transaction_count / CAST((SELECT sum(transaction_count) FROM risks
                                       WHERE snapshot_time = {_latest('risks')}) AS DOUBLE), 6) AS share
FROM risks WHERE snapshot_time = {_latest('risks')}""",
        "top_cities": f"""{_CITIES}
SELECT city, transaction_count FROM cities WHERE snapshot_time = {_latest('cities')}
ORDER BY transaction_count DESC, city ASC NULLS LAST LIMIT 10""",
        "kpi_summary": _SUMMARY_SQL,
        "dimension_counts": f"""{_ALL}
SELECT (SELECT count(DISTINCT payment_type) FROM payments WHERE snapshot_time = {_latest('payments')}) AS payment_types,
       (SELECT count(DISTINCT risk_level) FROM risks WHERE snapshot_time = {_latest('risks')}) AS risk_levels,
       (SELECT count(DISTINCT city) FROM cities WHERE snapshot_time = {_latest('cities')}) AS cities""",
        "currency_text": f"""WITH {_TX}
SELECT transaction_id, {_currency_sql('(amount / 8)')} AS eighth_text,
       {_currency_sql('(amount * 1000)')} AS thousandfold_text,
       printf('$%.2f', -amount) AS loss_text,
       format('{{:,}}', CAST(trunc(amount * 1000) AS BIGINT)) AS count_text
FROM tx""",
        "high_water_mark": f"""{_PAYMENTS}
SELECT max(snapshot_time) AS max_time FROM payments WHERE snapshot_time <= TIMESTAMP '{MARK}'""",
        "incremental_new_rows": f"""{_PAYMENTS}
SELECT * FROM payments WHERE snapshot_time >
  (SELECT max(snapshot_time) FROM payments WHERE snapshot_time <= TIMESTAMP '{MARK}')""",
        "backfill_rows": f"{_CITIES} SELECT * FROM cities",
        "freshness": _freshness_sql(AS_OF_FRESH),
        "freshness_stale": _freshness_sql(AS_OF_STALE),
        "table_report": f"{_ALL} "
        + _over_tables(
            "SELECT '{name}' AS table_name, count(*) AS n_rows, max(snapshot_time) AS latest_snapshot FROM {table}"
        ),
        "bronze_stream": f"""WITH {_TX}
SELECT transaction_id, amount, city, CAST(transaction_id AS BIGINT) % 4 AS "partition" FROM tx""",
        "silver_stream": f"""WITH {_SILVER}
SELECT {base}, is_high_value, is_night_transaction, risk_level FROM silver""",
        "gold_stream_payment": f"WITH {_SILVER} {_metrics('payment_type')}",
        "gold_stream_risk": f"WITH {_SILVER} {_metrics('risk_level')}",
        "gold_stream_city": f"WITH {_SILVER} {_metrics('city', _TOP_20)}",
        "gold_stream_before_restart": f"""WITH {_SILVER}
SELECT * REPLACE (TIMESTAMP '{STAMPS[BATCHES - 1]}' AS snapshot_time)
FROM ({_metrics('payment_type').replace('FROM silver', f"FROM silver WHERE transaction_timestamp < TIMESTAMP '{SPLIT}'")})""",
        "ledger_stream": f"{first_writes} SELECT {entry_columns} FROM scored",
        "alert_stream": f"{first_writes} SELECT {alert_columns} FROM scored WHERE is_fraud",
    }

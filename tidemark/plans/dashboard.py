"""Every frame the dashboard shows, from the three histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DIMENSIONS, HISTORY_TABLES, JdbcTarget
from tidemark.operators import kpi
from tidemark.operators.snapshots import TIME
from tidemark.sources import jdbc_trend


def frames(
    recent: dict[str, DataFrame], trends: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """``recent`` holds the histories. With ``trends``, from a source that can make them, the two newest snapshots do."""
    latest = _ordered(recent)
    return {
        "summary": kpi.summary(*latest),
        **(trends or lake_trends(recent)),
        "payment_distribution": kpi.payment_distribution(latest[0]),
        "risk_distribution": kpi.risk_distribution(latest[1]),
        "top_cities": kpi.top_cities(latest[2]),
        "dimension_counts": kpi.dimension_counts(*latest),
    }


def lake_trends(histories: dict[str, DataFrame]) -> dict[str, DataFrame]:
    payments, risks, _ = _ordered(histories)
    return {
        "revenue_trend": kpi.revenue_trend(payments),
        "transaction_trend": kpi.transaction_trend(payments),
        "high_risk_trend": kpi.high_risk_trend(risks),
    }


def served_trends(spark: SparkSession, target: JdbcTarget) -> dict[str, DataFrame]:
    """The trends, a row per snapshot, as the database groups and filters them."""
    payments, risks = HISTORY_TABLES["payment_type"], HISTORY_TABLES["risk_level"]
    revenue = jdbc_trend(spark, target, payments, "total_amount").withColumnRenamed("total_amount", "revenue")
    count = F.col("transaction_count").cast("bigint")
    counted = jdbc_trend(spark, target, payments, "transaction_count")
    high = jdbc_trend(spark, target, risks, "transaction_count", {"risk_level": "HIGH"})
    return {
        "revenue_trend": revenue.orderBy(TIME),
        "transaction_trend": counted.select(TIME, count.alias("transactions")).orderBy(TIME),
        "high_risk_trend": high.select(TIME, count.alias("transaction_count")).orderBy(TIME),
    }


def register_views(histories: dict[str, DataFrame]) -> None:
    """Makes the histories available to ``spark.sql`` under the names of their serving tables."""
    for table, history in histories.items():
        history.createOrReplaceTempView(table)


def _ordered(histories: dict[str, DataFrame]) -> list[DataFrame]:
    return [histories[HISTORY_TABLES[dimension]] for dimension in DIMENSIONS]

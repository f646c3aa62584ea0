"""The figures behind the dashboard's cards and charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import TOP_CITIES_SHOWN
from tidemark.functions.formatting import currency, grouped_integer
from tidemark.operators import gold
from tidemark.operators.snapshots import TIME, latest_snapshot, latest_time, previous_or_latest_time


def revenue_trend(payments: DataFrame) -> DataFrame:
    return payments.groupBy(TIME).agg(F.sum("total_amount").alias("revenue")).orderBy(TIME)


def transaction_trend(payments: DataFrame) -> DataFrame:
    return payments.groupBy(TIME).agg(F.sum("transaction_count").alias("transactions")).orderBy(TIME)


def high_risk_trend(risks: DataFrame) -> DataFrame:
    high = risks.where(F.col("risk_level") == "HIGH")
    return high.select(TIME, "transaction_count").orderBy(TIME)


def payment_distribution(payments: DataFrame) -> DataFrame:
    return latest_snapshot(payments).select("payment_type", "transaction_count")


def risk_distribution(risks: DataFrame) -> DataFrame:
    """Counts of the latest snapshot and their shares of its total."""
    latest = latest_snapshot(risks)
    total = latest.agg(F.sum("transaction_count").alias("total")).scalar()
    return latest.select(
        "risk_level", "transaction_count", (F.col("transaction_count") / total).alias("share")
    )


def top_cities(cities: DataFrame, n: int = TOP_CITIES_SHOWN) -> DataFrame:
    return gold.top_n(latest_snapshot(cities).select("city", "transaction_count"), "city", n)


def dimension_counts(payments: DataFrame, risks: DataFrame, cities: DataFrame) -> DataFrame:
    """Distinct values in the latest snapshots; null is not counted."""

    def distinct(history: DataFrame, dimension: str, name: str) -> DataFrame:
        return latest_snapshot(history).agg(F.count_distinct(dimension).alias(name))

    return distinct(payments, "payment_type", "payment_types").withColumns(
        {
            "risk_levels": distinct(risks, "risk_level", "risk_levels").scalar(),
            "cities": distinct(cities, "city", "cities").scalar(),
        }
    )


def summary(payments: DataFrame, risks: DataFrame, cities: DataFrame) -> DataFrame:
    """One row: totals of the latest snapshots, of the ones before, their differences and texts.

    Each history has its own clock, so latest and previous are found per table. A missing snapshot
    counts as zero.
    """
    parts = [
        _latest_and_previous(
            payments, revenue=F.col("total_amount"), transactions=F.col("transaction_count")
        ).withColumnRenamed("newest", "last_updated"),
        _latest_and_previous(
            risks, high_risk=F.when(F.col("risk_level") == "HIGH", F.col("transaction_count"))
        ).drop("newest"),
        latest_snapshot(cities).agg(F.count_distinct("city").alias("cities_covered")),
    ]
    # Three rows with disjoint columns become one.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])

    def delta(measure: str) -> Column:
        return F.col(f"latest_{measure}") - F.col(f"previous_{measure}")

    figures = row.select(
        F.col("latest_revenue").alias("total_revenue"),
        "previous_revenue",
        delta("revenue").alias("revenue_delta"),
        F.col("latest_transactions").alias("total_transactions"),
        "previous_transactions",
        delta("transactions").alias("transaction_delta"),
        F.col("latest_high_risk").alias("high_risk_transactions"),
        "previous_high_risk",
        delta("high_risk").alias("high_risk_delta"),
        "cities_covered",
        "last_updated",
    )
    return figures.withColumns(
        {
            "revenue_text": currency(F.col("total_revenue")),
            "revenue_delta_text": currency(F.col("revenue_delta")),
            "transactions_text": grouped_integer(F.col("total_transactions")),
            "transaction_delta_text": grouped_integer(F.col("transaction_delta")),
            "high_risk_text": grouped_integer(F.col("high_risk_transactions")),
            "high_risk_delta_text": grouped_integer(F.col("high_risk_delta")),
        }
    )


def _latest_and_previous(history: DataFrame, **measures: Column) -> DataFrame:
    """One row of sums over the latest and the previous snapshot, from one scan of just those two."""
    latest = latest_time(history)
    tagged = history.where(F.col(TIME) >= previous_or_latest_time(history)).select(
        F.col(TIME),
        (F.col(TIME) == latest).alias("_is_latest"),
        *[measure.alias(name) for name, measure in measures.items()],
    )

    def total(name: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0))

    return tagged.agg(
        *[total(name, F.col("_is_latest")).alias(f"latest_{name}") for name in measures],
        *[total(name, ~F.col("_is_latest")).alias(f"previous_{name}") for name in measures],
        F.max(TIME).alias("newest"),
    )

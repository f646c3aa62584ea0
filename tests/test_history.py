import pytest
from helpers import history, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.formatting import currency, grouped_integer
from tidemark.operators import kpi, monitor, snapshots
from tidemark.plans import dashboard

T1, T2, T3 = (f"2001-01-0{i} 00:00:00" for i in (1, 2, 3))


@pytest.fixture(scope="module")
def tables(spark):
    payments = history(
        spark, "payment_type", ("UPI", 10, 1000, T1), ("UPI", 30, 2500, T2), ("CARD", 5, 500.5, T2),
        ("UPI", 40, 3000, T3), ("CARD", 6, 600, T3), (None, 1, 9, T3),
    )
    risks = history(spark, "risk_level", ("HIGH", 3, 300, T1), ("HIGH", 7, 700, T2), ("LOW", 99, 99, T2))
    cities = history(spark, "city", ("a", 5, 5, T2), ("b", 5, 5, T3), ("c", 9, 9, T3), (None, 5, 5, T3))
    return payments, risks, cities


@pytest.fixture(scope="module")
def empty(spark):
    return tuple(spark.createDataFrame([], schemas.gold(d)) for d in ("payment_type", "risk_level", "city"))


def test_latest_and_previous(tables, empty):
    payments, risks, _ = tables
    assert rows(snapshots.latest_snapshot(payments), "payment_type") == [("CARD",), ("UPI",), (None,)]
    assert rows(snapshots.previous_snapshot(payments), "transaction_count") == [(30,), (5,)]
    assert rows(snapshots.previous_snapshot(risks), "transaction_count") == [(3,)]
    assert snapshots.latest_snapshot(empty[0]).count() == 0
    assert snapshots.previous_snapshot(empty[0]).count() == 0
    assert snapshots.previous_snapshot(payments.where(F.col("snapshot_time") == T1)).count() == 0


def test_summary(tables):
    (row,) = kpi.summary(*tables).withColumn("last_updated", F.col("last_updated").cast("string")).collect()
    assert row["total_revenue"] == 3609.0 and row["previous_revenue"] == 3000.5
    assert row["revenue_delta"] == 608.5
    assert (row["total_transactions"], row["previous_transactions"], row["transaction_delta"]) == (47, 35, 12)
    assert (row["high_risk_transactions"], row["previous_high_risk"], row["high_risk_delta"]) == (7, 3, 4)
    assert row["cities_covered"] == 2
    assert row["revenue_text"] == "$3.61K" and row["revenue_delta_text"] == "$608.50"
    assert row["last_updated"] == T3


def test_summary_with_one_snapshot_and_no_high_risk(spark, tables):
    payments, _, cities = tables
    first = payments.where(F.col("snapshot_time") == T1)
    (row,) = kpi.summary(first, history(spark, "risk_level", ("LOW", 1, 1, T1)), cities).collect()
    assert (row["total_transactions"], row["previous_transactions"], row["transaction_delta"]) == (10, 0, 10)
    assert (row["total_revenue"], row["previous_revenue"]) == (1000.0, 0.0)
    assert (row["high_risk_transactions"], row["previous_high_risk"]) == (0, 0)


def test_summary_of_nothing(empty):
    (row,) = kpi.summary(*empty).collect()
    assert (row["total_revenue"], row["total_transactions"], row["high_risk_transactions"]) == (0.0, 0, 0)
    assert row["cities_covered"] == 0 and row["last_updated"] is None and row["revenue_text"] == "$0.00"


def test_trends_are_ordered(tables):
    payments, risks, _ = tables
    assert [r["revenue"] for r in kpi.revenue_trend(payments).collect()] == [1000.0, 3000.5, 3609.0]
    assert [r["transactions"] for r in kpi.transaction_trend(payments).collect()] == [10, 35, 47]
    assert [r["transaction_count"] for r in kpi.high_risk_trend(risks).collect()] == [3, 7]


def test_distributions(tables):
    payments, risks, cities = tables
    assert rows(kpi.payment_distribution(payments)) == [("CARD", 6), ("UPI", 40), (None, 1)]
    assert rows(kpi.risk_distribution(risks)) == [("HIGH", 7, 7 / 106), ("LOW", 99, 99 / 106)]
    assert [r["city"] for r in kpi.top_cities(cities).collect()] == ["c", "b", None]
    assert [r["city"] for r in kpi.top_cities(cities, 2).collect()] == ["c", "b"]
    assert rows(kpi.dimension_counts(*tables)) == [(2, 2, 2)]


def test_bounds_reach_the_scan(spark, tables, tmp_path):
    tables[0].write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    plan = snapshots.latest_snapshot(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(snapshot_time,ScalarSubquery" in plan


def test_newer_than(tables, empty):
    payments = tables[0]
    assert snapshots.newer_than(payments, None).count() == 6
    assert snapshots.newer_than(payments, T2).count() == 3
    assert snapshots.newer_than(payments, T3).count() == 0
    assert rows(snapshots.high_water_mark(empty[0])) == [(None,)]


def test_currency(spark):
    expected = {
        -2_500_000.0: "$-2500000.00", 999.999: "$1000.00", 1_000.0: "$1.00K", 1_000_000.0: "$1.00M",
        999_999.99: "$1000.00K", 0.0: "$0.00", 0.125: "$0.12", 0.375: "$0.38", 2675.0: "$2.67K",
        1_234_567_890.0: "$1234.57M", -0.5: "$-0.50", float("inf"): "$infM",
    }
    df = spark.createDataFrame([(v,) for v in [*expected, float("nan")]], "v double")
    found = [tuple(r) for r in df.select("v", currency(F.col("v")).alias("text")).collect()]
    assert found.pop()[1] == "$nan"
    assert dict(found) == expected


def test_grouped_integer(spark):
    df = spark.createDataFrame([(0.0,), (999.9,), (1234567.0,), (-1234567.0,)], "v double")
    assert [r[0] for r in df.select(grouped_integer(F.col("v")).alias("text")).collect()] == ["0", "999", "1,234,567", "-1,234,567"]


def checked(at, **tables):
    return monitor.freshness(monitor.table_report(tables), at)


def test_freshness(tables, empty):
    found = checked("2001-01-03 00:10:00", p=tables[0], r=tables[1], none=empty[2])
    status = {r["table_name"]: (r["age_minutes"], r["status"]) for r in found.collect()}
    assert status == {"p": (10.0, "OK"), "r": (1450.0, "STALE"), "none": (None, "EMPTY")}
    assert rows(checked("2001-01-03 00:10:00.000001", p=tables[0]), "status") == [("STALE",)]


def test_assert_fresh_stops_at_the_first_bad_table(tables, empty):
    found = checked("2001-01-03 00:05:00", p=tables[0], r=tables[1], c=tables[2], none=empty[2])
    monitor.assert_fresh(found, ["p", "c"])
    with pytest.raises(monitor.UnhealthyTable, match="none: no snapshot was ever written"):
        monitor.assert_fresh(found, ["p", "none", "r"])
    with pytest.raises(monitor.UnhealthyTable, match="r: the newest snapshot, of 2001-01-02 .*, is 1445.00 minutes old"):
        monitor.assert_fresh(found, ["r", "none"])


def test_table_report(tables, empty):
    found = monitor.table_report({"p": tables[0], "none": empty[0]})
    assert rows(found.select("table_name", "n_rows")) == [("none", 0), ("p", 6)]


def test_dashboard_frames_and_sql_on_the_histories(spark, tables):
    named = dict(zip(("payment_metrics_history", "risk_metrics_history", "city_metrics_history"), tables))
    frames = dashboard.frames(named)
    assert rows(dashboard.frames(named, dashboard.lake_trends(named))["revenue_trend"]) == rows(frames["revenue_trend"])
    assert list(frames) == [
        "summary", "revenue_trend", "transaction_trend", "high_risk_trend", "payment_distribution",
        "risk_distribution", "top_cities", "dimension_counts",
    ]
    recent = {
        name: df.where(F.col("snapshot_time") >= snapshots.previous_or_latest_time(df)) for name, df in named.items()
    }
    for name, frame in dashboard.frames(recent, dashboard.lake_trends(named)).items():
        assert rows(frame) == rows(frames[name])

    dashboard.register_views(named)
    latest = spark.sql(
        """SELECT * FROM payment_metrics_history
           WHERE snapshot_time = (SELECT MAX(snapshot_time) FROM payment_metrics_history)"""
    )
    assert rows(latest) == rows(snapshots.latest_snapshot(tables[0]))
    trend = spark.sql(
        "SELECT snapshot_time, SUM(total_amount) AS revenue FROM payment_metrics_history GROUP BY 1 ORDER BY 1"
    )
    assert trend.collect() == frames["revenue_trend"].collect()

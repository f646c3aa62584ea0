from helpers import rows, silver_rows

from tidemark.operators import gold


def test_metrics_with_null_as_a_group(spark):
    silver = silver_rows(
        spark, ("1", 10.0, "UPI", "A", "LOW"), ("2", 30.0, "UPI", None, "LOW"), ("3", 5.0, None, None, "LOW")
    )
    assert rows(gold.metrics(silver, "city")) == [("A", 1, 10.0, 10.0), (None, 2, 35.0, 17.5)]
    assert rows(gold.metrics(silver, "payment_type")) == [("UPI", 2, 40.0, 20.0), (None, 1, 5.0, 5.0)]


def test_top_n_breaks_ties_by_name_nulls_last(spark):
    cities = ["e", "d", "d", "c", "c", None, None, "b", "a", "a", "a"]
    silver = silver_rows(spark, *[(str(i), 1.0, "UPI", c, "LOW") for i, c in enumerate(cities)])
    measured = gold.metrics(silver, "city")
    ranked = ["a", "c", "d", None, "b", "e"]
    for n in range(1, 7):
        assert [r["city"] for r in gold.top_n(measured, "city", n).collect()] == ranked[:n]


def test_top_n_is_not_a_global_sort(spark, tmp_path):
    silver_rows(spark, ("1", 1.0, "UPI", "A", "LOW")).write.parquet(str(tmp_path / "s"))
    df = gold.top_n(gold.metrics(spark.read.parquet(str(tmp_path / "s")), "city"), "city", 20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert "ReadSchema: struct<amount:double,city:string>" in plan
    assert "partial_sum" in plan


def test_one_stamp_per_snapshot(spark):
    silver = silver_rows(spark, ("1", 1.0, "UPI", "A", "LOW"), ("2", 1.0, "CARD", "B", "LOW"))
    given = gold.snapshot(silver, "city", 1, "2001-01-01 00:00:00")
    assert rows(given.selectExpr("city", "date_format(snapshot_time, 'yyyy-MM-dd') AS at")) == [("A", "2001-01-01")]
    assert gold.snapshot(silver, "payment_type").select("snapshot_time").distinct().count() == 1


def test_row_count(spark):
    assert rows(gold.row_count(spark.range(7))) == [(7,)]

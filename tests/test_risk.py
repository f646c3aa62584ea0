from helpers import payload, texts

from tidemark.config import FraudRules
from tidemark.operators import ledger


def scored(spark, *values, rules=FraudRules()):
    return [
        (r["is_fraud"], r["fraud_score"], r["reason"])
        for r in ledger.score(ledger.parse(texts(spark, *values)), rules).collect()
    ]


VERY_HIGH = (True, 95, "Suspicious Very High Amount")
HIGH = (True, 80, "High Amount Transaction")
UNUSUAL = (True, 70, "Transaction During Unusual Hours")
NONE = (False, 0, None)


def test_first_matching_rule_decides(spark):
    cases = [
        (4500.01, 12, VERY_HIGH), (4500.0, 12, HIGH), (4499.99, 12, HIGH), (4000.01, 12, HIGH),
        (4000.0, 12, NONE), (3999.99, 12, NONE), (4500.01, 2, VERY_HIGH), (4000.01, 2, HIGH),
        (10.0, 0, UNUSUAL), (10.0, 4, UNUSUAL), (10.0, 5, NONE), (10.0, 6, NONE), (10.0, 23, NONE),
    ]
    found = scored(spark, *[payload("a", amount, f"2001-02-03T{hour:02}:59:59") for amount, hour, _ in cases])
    assert found == [expected for *_, expected in cases]


def test_unknown_time_is_not_unusual(spark):
    assert scored(spark, payload("a", at=None), payload("b", at="garbage")) == [NONE, NONE]


def test_amount_as_text_is_accepted(spark):
    assert scored(spark, payload("a", "4600.5"), payload("b", " 12 ")) == [VERY_HIGH, NONE]


def test_nan_exceeds_no_limit(spark):
    assert scored(spark, payload("a", "NaN"), payload("b", "NaN", "2001-02-03T01:00:00")) == [NONE, UNUSUAL]


def test_hour_is_taken_as_written(spark):
    assert scored(
        spark,
        payload("a", at="2001-02-03T23:00:00-05:00"),
        payload("b", at="2001-02-03T03:00:00-05:00"),
        payload("c", at="2001-02-03T03:00:00Z"),
    ) == [NONE, UNUSUAL, UNUSUAL]


def test_rules_are_settings(spark):
    rules = FraudRules(very_high_amount=20, high_amount=10, unusual_hours=(12, 12), high=(1, "x"))
    assert scored(spark, payload("a", 15.0), payload("b", 5.0), rules=rules) == [(True, 1, "x"), UNUSUAL]


def test_rows_the_ledger_cannot_key_or_score_are_dropped(spark):
    assert scored(spark, payload(None), payload("a", None), payload("b", "many"), "hello") == []

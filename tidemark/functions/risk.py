"""Fraud rules as column expressions: the first rule that matches decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import FraudRules


def _exceeds(amount: Column, limit: float) -> Column:
    # Spark orders NaN above every number; no rule on the amount holds for it.
    return (amount > limit) & ~F.isnan(amount)


def matched_rule(amount: Column, event_time: Column, rules: FraudRules = FraudRules()) -> Column:
    """Struct (score, reason) of the first matching rule, or null."""

    def outcome(rule: tuple[int, str]) -> Column:
        score, reason = rule
        return F.struct(F.lit(score).alias("score"), F.lit(reason).alias("reason"))

    return (
        F.when(_exceeds(amount, rules.very_high_amount), outcome(rules.very_high))
        .when(_exceeds(amount, rules.high_amount), outcome(rules.high))
        .when(F.hour(event_time).between(*rules.unusual_hours), outcome(rules.unusual))
    )


def score_columns(amount: Column, event_time: Column, rules: FraudRules = FraudRules()) -> dict[str, Column]:
    """The columns is_fraud, fraud_score and reason."""
    rule = matched_rule(amount, event_time, rules)
    return {
        "is_fraud": rule.isNotNull(),
        "fraud_score": F.coalesce(rule["score"], F.lit(0)),
        "reason": rule["reason"],
    }

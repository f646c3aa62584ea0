"""Derived features of a transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import Thresholds


def is_high_value(amount: Column, thresholds: Thresholds = Thresholds()) -> Column:
    return F.coalesce(amount > thresholds.high_value, F.lit(False))


def is_night(event_time: Column, thresholds: Thresholds = Thresholds()) -> Column:
    """False, not null, where the time is unknown."""
    return F.coalesce(F.hour(event_time).between(*thresholds.night_hours), F.lit(False))


def risk_level(amount: Column, thresholds: Thresholds = Thresholds()) -> Column:
    return (
        F.when(amount > thresholds.high_risk, "HIGH")
        .when(amount > thresholds.medium_risk, "MEDIUM")
        .otherwise("LOW")
    )

"""Text of the KPI cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_decimals(value: Column) -> Column:
    """A double with two decimals, rounded from its exact binary value, ties to even.

    ``format_string`` would round the shortest decimal text of the double, which differs at apparent
    ties: 2.675 is below the tie in binary.
    """
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise(F.call_function("format_number", value, F.lit("0.00")))
    )


def currency(value: Column) -> Column:
    """$1.25M, $3.40K or $12.00. Negative values are never shortened."""
    million, thousand = 1_000_000, 1_000
    unit = (
        F.when(F.isnan(value), 1).when(value >= million, million).when(value >= thousand, thousand).otherwise(1)
    )
    suffix = F.when(unit == million, "M").when(unit == thousand, "K").otherwise("")
    return F.concat(F.lit("$"), two_decimals(value / unit), suffix)


def grouped_integer(value: Column) -> Column:
    """1234567 as 1,234,567."""
    return F.format_number(value.cast("bigint"), 0)

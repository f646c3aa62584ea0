"""Prefix sums over a table in a global order, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spread import written

# Rows that one task sorts at once.
ROWS_PER_RANGE = 50_000


def running(
    table: DataFrame, groups: Sequence[str], order: Sequence[str], value: Column, name: str, rows: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same group that stand before this one in ``order``."""
    return prefixes(table, groups, order, {name: value}, rows)


def prefixes(
    table: DataFrame, groups: Sequence[str], order: Sequence[str], values: dict[str, Column], rows: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adds prefix sums of several values, each without the row's own.

    ``table`` is read twice and should be a written one; groups and order have no nulls, and the order does not tie. Rows are
    range-partitioned by group and order and written with the number of their range. A range's sum is one row, and sums of the
    ranges before it are what its rows start from; a group of any size is as many ranges as it needs.
    """
    ranges = 1 + table.count() // rows
    dealt = table.repartitionByRange(ranges, *groups, *order).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    keys = [*groups, "_range"]
    sums = dealt.groupBy(*keys).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    starts = sums.select(*keys, *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), none).alias(f"_start_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumns({f"_within_{n}": F.coalesce(F.sum(v).over(before), none) for n, v in values.items()})
    added = [(F.col(f"_start_{n}") + F.col(f"_within_{n}")).cast("long").alias(n) for n in values]
    return within.join(starts, keys).select(*table.columns, *added)

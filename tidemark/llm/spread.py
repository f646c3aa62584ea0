"""Helpers that keep work spread: written tables, gapless numbers, hot-key lookups, workers' imports."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])

# Rows that one task numbers at once.
ROWS_PER_BUCKET = 50_000


def importable(spark: SparkSession) -> None:
    """Lets Python workers that see this folder import the package, wherever the driver was started."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, ROOT)))


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and not lost with an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(
    table: DataFrame, groups: Sequence[str], order: Sequence[str], salt: Sequence[str], name: str
) -> DataFrame:
    """Adds a number, gapless from 0 in each group. ``table`` is read twice and should be a written one.

    A group is dealt to buckets by a hash of ``salt``; rows are ranked within a bucket, and the counts of
    the buckets before it are added. So no task sorts a whole group, however large.
    """
    buckets = 64 + table.count() // ROWS_PER_BUCKET
    dealt = table.withColumn("_bucket", F.pmod(F.xxhash64(*salt), F.lit(buckets)))
    keys = [*groups, "_bucket"]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys).orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    return (
        ranked.join(before, keys)
        .withColumn(name, (F.col("_before") + F.col("_rank")).cast("long"))
        .drop("_bucket", "_before", "_rank")
    )


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; of a null id: null."""
    return F.crc32(F.col(id_column).cast("string")) % modulus

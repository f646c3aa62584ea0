"""Connected components of an edge table, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import written


def components(edges: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node that links lead to, for all nodes of the edges.

    Alternates two star operations: every node's larger neighbours, and then all its neighbours, are linked to the
    least of them. The number of rounds is logarithmic in practice. Each round is a written table. A round joins
    nodes with the least of their neighbours; the least is one row per node, so a node with very many
    neighbours is split by the skew handling of the join.
    """
    pairs = edges.select(F.least(low, high).alias("a"), F.greatest(low, high).alias("b")).where("a < b").distinct()
    pairs = written(pairs, "edges")
    before = None
    while True:
        pairs = _star(_both_ways(pairs), larger_only=True)
        pairs = _star(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")), larger_only=False)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
                pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        before = state


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )


def _star(directed: DataFrame, larger_only: bool) -> DataFrame:
    """Links neighbours of each node (``other``) to the least of them and the node itself."""
    least = written(
        directed.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node")), "least"
    )
    joined = directed.join(least, "node")
    if larger_only:
        linked = joined.where("other > node").select(F.col("least").alias("a"), F.col("other").alias("b"))
    else:
        # Each node stays linked too.
        linked = joined.where("other != least").select(F.col("least").alias("a"), F.col("other").alias("b")).unionAll(
            least.where("least < node").select(F.col("least").alias("a"), F.col("node").alias("b"))
        )
    return written(linked.where("a < b").distinct(), "edges")

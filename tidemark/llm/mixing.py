"""A mix of sources by weight: each source gives as many words as its share, over again where it has too few.

Documents stand in a random order by a hash of their id, range-sorted within their source. Prefix sums of their
sizes tell which words of the source come before each; a source's budget is its target to the nearest word, and what the budget
covers, epoch after epoch, is taken. So the words taken of a source are its budget exactly: one document of a source may be taken
in part (its first words), all others whole.

Targets: the sources share ``share`` times all words by weight. Sources stand by code point, a null source last, and weights go
round among them. A target stops at ``epochs`` times its source's words, and the excess is shared among the others by weight,
until none is above. Each round is one aggregate over the table of sources; one row comes to the driver.

Null and empty texts have size 0 and are taken 0 times; texts of any length count whole. A null source is a source of its own,
not the empty one. Repeated rows (one id, source and size) are one row with a count while they are sorted, and come out as often as
they came in; copies are interchangeable, so ties cannot change the result. A null id is an id like any other. Empty tables give
none. Only ``doc_id``, ``text`` and ``source`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.prefix import running
from tidemark.llm.spread import written

# Fixed values
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"

# Copies of one row that one task brings back at once.
COPIES = 10_000

SOURCE = ["unnamed", "source"]


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(19,0)")


def sizes(docs: DataFrame) -> DataFrame:
    """Id, source and number of words, and how many rows have them."""
    source = F.col("source")
    return (
        docs.select(
            "doc_id",
            source.isNull().alias("unnamed"),
            F.coalesce(source, F.lit("")).alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("doc_id", *SOURCE, "size")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def budgets(
    units: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """Per source its words, target and budget in whole words. ``share`` is a fraction of all words, at most ``epochs``."""
    parts, whole = share
    if parts > epochs * whole:
        raise ValueError(f"{parts}/{whole} of all words cannot be had in {epochs} epochs")
    found = units.groupBy(*SOURCE).agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranked = running(written(found, "sources"), [], SOURCE, F.lit(1), "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", weight).drop("rank"), "weights")

    # All in units of 1/whole words. Of the sources below their limit: the words left for them, and their weights.
    limit = _exact("source_size") * (epochs * whole)
    total = sources.agg(
        F.coalesce(F.sum(_exact("source_size") * parts), F.lit(0)).cast("decimal(38,0)").alias("rest"),
        F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"),
    ).first()
    rest, weight_left = total
    while True:
        above = _above(limit, rest, weight_left)
        full = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).cast("decimal(38,0)").alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        now = total["rest"] - full["taken"], full["weight"]
        if now == (rest, weight_left):
            break
        rest, weight_left = now
    above = _above(limit, rest, weight_left)
    most = F.col("source_size") * epochs
    share_words = _exact("weight") * F.lit(rest)
    # At least 1, for a table without sources.
    divisor = max(weight_left, 1) * whole
    shared = sources.withColumn("_share", share_words.cast("decimal(38,0)"))
    return shared.select(
        *SOURCE,
        "source_size",
        F.when(above, most.cast("double")).otherwise(F.col("_share").cast("double") / F.lit(float(divisor))).alias("target"),
        F.when(above, most).otherwise(F.expr(f"(2 * _share + {divisor}) div {2 * divisor}")).alias("budget"),
    )


def _above(limit: Column, rest, weight: int) -> Column:
    """Whether a source's share by weight is more than its limit."""
    return _exact("weight") * F.lit(rest) > limit * F.lit(weight)


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = ""
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (its source's) and taken, its words in the mix."""
    units = written(sizes(docs), "sizes")
    plan = written(budgets(units, weights, share, epochs), "budgets")
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = units.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), id_text, F.col("size").cast("string"))))
    # Equal keys of one source have equal sizes; whether the id is null decides between "" and none.
    keyed = keyed.withColumns({"no_id": F.col("doc_id").isNull(), "id_text": id_text})
    placed = running(
        written(keyed, "keys"), SOURCE, ["key", "no_id", "id_text", "size"], F.col("size") * F.col("copies"), "before"
    )
    planned = placed.join(plan, SOURCE)
    single = planned.where("copies = 1")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}")))
    blocks = planned.where("copies > 1").withColumn("block", block).repartition("doc_id", "block")
    first = F.col("block") * COPIES
    copy = F.explode(F.sequence(first, F.least(first + COPIES, F.col("copies")) - 1))
    several = blocks.withColumn("copy", copy).withColumn("before", F.col("before") + F.col("copy") * F.col("size"))
    rows = single.unionByName(several.select(*single.columns))

    empty = F.col("source_size") == 0
    whole = F.when(empty, 0).otherwise(F.expr("budget div nullif(source_size, 0)"))
    rest = F.when(empty, 0).otherwise(F.expr("budget % nullif(source_size, 0)"))
    size = F.col("size")
    taken = whole * size + F.greatest(F.lit(0), F.least(size, rest - F.col("before")))
    return rows.select(
        "doc_id",
        F.when(~F.col("unnamed"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
    )

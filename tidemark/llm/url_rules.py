"""URL filter: given host and path rules first, association rules mined from labels for the rest.

Everything is column expressions and Spark's own FP-growth. Tokens of a URL are its host's labels, its path
segments with digit runs as ``0``, and its query's keys. FP-growth finds token combinations that are frequent
among bad pages; a combination that implies the bad label with enough confidence and support is a blocking
rule. A rule is posted in an inverted index under its rarest token; a URL's token set looks up its tokens and
keeps the rules that it contains whole.

**Whole mining.** A basket of k items has 2^k combinations, so a basket is made small before it is mined. Tokens of
too few bad pages can be in no rule. Tokens that stand in the same labelled pages are one *item*, which a URL holds if
it holds any of them. An item whose pages are all bad is a rule by itself, and combinations with it say no more. If no
bad page is left with more than ``MAX_ITEMS`` items, FP-growth finds the combinations: at most 2^MAX_ITEMS of a page.
Otherwise they grow level by level in joins (``_grown``), where a combination is given up, with all that contain it,
as soon as a part of it is as sure; that finds the same rules in baskets of any length. No item or combination is left
out by a limit, so URLs whose many items come and go freely, in good pages as in bad ones, can make as many
combinations as there are. Support and confidence are exact: counted over all labelled pages and all their tokens.

A URL that is null or has no ``://`` has an empty host, an empty path and no tokens, fits no rule, and is allowed.
Without labelled pages, or where no combination is confident enough, no rule is mined and the rest is allowed; a null
label or a label without its page counts for nothing. A very long URL is one row of many tokens. Of rules that fire
with the same confidence, the last by its tokens is named. Repeated pages are judged alike, one row each; a repeated
label counts once, as bad if any of its rows says so. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spread import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GIVEN_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MIN_SUPPORT = 0.001
MIN_ROWS = 5
MIN_CONFIDENCE = 0.5
MAX_ITEMS = 10


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    labels = F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(
        F.split(path(url), "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0"))
    )
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_sort(F.array_distinct(F.filter(F.concat(labels, segments, keys), lambda x: F.length(x) > 2)))


def fitting_rule(host_: Column, path_: Column, rules=GIVEN_RULES) -> Column:
    """Struct of rule and verdict of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        suffix, slash, rest = rule.partition("/")
        fits = ((host_ == suffix) | F.endswith(host_, F.lit(f".{suffix}"))) & F.startswith(path_, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_rows: int = MIN_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
    max_items: int = MAX_ITEMS,
) -> tuple[DataFrame, DataFrame] | None:
    """Blocking rules from rows of (tokens, bad), and the items that they are made of; None if there is no rule.

    Rules: rule_tokens (items), anchor, confidence, support, rows. Items: token, item; an item is named by its least token.

    A rule needs the confidence, the support (share of the labelled rows) and ``min_rows`` bad rows. A rule goes where
    a part of it is a rule already with no less confidence. ``max_items``: the longest basket for FP-growth.
    """
    labelled = written(labelled.select("tokens", F.col("bad").cast("long").alias("bad")), "labelled")
    sets = written(labelled.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")), "token_sets")
    n = sets.agg(F.sum("n")).first()[0]
    if not n:
        return None
    need = max(min_rows, math.ceil(min_support * n - 1e-9), 1)

    # Equal n and equal hashes of the sets that hold them: tokens that stand in the same pages.
    pages = [F.bit_xor(F.xxhash64("tokens", F.lit(seed))).alias(f"pages{seed}") for seed in (0, 1)]
    tokens_ = (
        sets.select("tokens", "n", "bad", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), *pages)
        .where(F.col("bad") >= need)
    )
    same = ["n", "bad", "pages0", "pages1"]
    members = written(tokens_.withColumn("item", F.min("token").over(Window.partitionBy(same))), "members")
    items = members.where("token = item").select("item", "n", "bad")

    # Every set with its items, those that point most to bad pages first.
    order = F.struct((-F.col("of.bad") / F.col("of.n")).alias("share"), (-F.col("of.bad")).alias("rows"), "item")
    in_sets = (
        sets.select("tokens", F.col("n").alias("set_n"), F.col("bad").alias("set_bad"), F.explode("tokens").alias("token"))
        .join(members.select("token", "item", F.struct("n", "bad").alias("of")), "token")
        .groupBy("tokens", "set_n", "set_bad")
        .agg(F.array_sort(F.collect_set(F.struct(order.alias("place"), (F.col("of.bad") < F.col("of.n")).alias("open")))).alias("found"))
    )
    item_sets = written(
        in_sets.select(
            "tokens",
            F.transform("found", lambda x: x["place"]["item"]).alias("items"),
            F.transform(F.filter("found", lambda x: x["open"]), lambda x: x["place"]["item"]).alias("basket"),
            F.col("set_n").alias("n"),
            F.col("set_bad").alias("bad"),
            F.monotonically_increasing_id().alias("set_id"),
        ),
        "item_sets",
    )
    counted = items.select(F.array("item").alias("rule_tokens"), F.col("item").alias("anchor"), "n", "bad")
    mixed = F.size("basket") > 1
    widest = F.max(F.when(F.col("bad") > 0, F.size("basket")))
    rows, widest = item_sets.where(mixed).agg(F.coalesce(F.sum("bad"), F.lit(0)), widest).first()
    if rows >= need and widest <= max_items:
        baskets = labelled.where("bad = 1").join(item_sets.where(mixed).select("tokens", "basket"), "tokens").select("basket")
        model = FPGrowth(itemsCol="basket", minSupport=(need - 0.5) / rows).fit(baskets)
        combined = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("rule_tokens"))
        found = _contained(item_sets.select("items", "n", "bad"), "items", written(_anchored(combined, items), "combinations"))
        counted = counted.unionByName(found.groupBy("rule_tokens", "anchor").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    elif rows >= need:
        grown = _grown(item_sets.where(mixed), items.where("bad < n"), need)
        counted = counted.unionByName(grown.join(_anchored(grown, items), "rule_tokens"))
    rules = counted.select("rule_tokens", "anchor", (F.col("bad") / F.col("n")).alias("confidence"), "bad")
    rules = written(rules.where((F.col("bad") >= need) & (F.col("confidence") >= min_confidence)), "rules")
    wholes = rules.select(F.col("rule_tokens").alias("whole"), F.col("confidence").alias("own"))
    implied = (
        _contained(wholes, "whole", rules)
        .where((F.size("rule_tokens") < F.size("whole")) & (F.col("confidence") >= F.col("own")))
        .select(F.col("whole").alias("rule_tokens"))
        .distinct()
    )
    kept = rules.join(implied, "rule_tokens", "left_anti").select(
        "rule_tokens", "anchor", "confidence", (F.col("bad") / n).alias("support"), F.col("bad").alias("rows")
    )
    return written(kept, "index"), members.select("token", "item")


def _grown(item_sets: DataFrame, items: DataFrame, need: int) -> DataFrame:
    """Combinations of at least ``need`` bad rows that can be a rule to keep, from baskets of any length: rule_tokens, n, bad.

    Combinations that differ in their last items make the next longer ones. One is given up, and no longer one made of it,
    if too few bad rows hold it, or if leaving an item out adds no good row: the part then has no fewer bad rows and
    is as sure, here and in all longer ones. One without a good row is kept, but nothing longer can be surer.
    """
    good = F.col("n") - F.col("bad")
    parts = items.select(F.array("item").alias("part"), good.alias("part_good"))
    first = item_sets.select("set_id", "n", "bad", F.array().cast("array<string>").alias("prefix"), F.explode("basket").alias("last"))
    holders, levels = written(first, "holders"), []
    while True:
        others = holders.select("set_id", "prefix", F.col("last").alias("next"))
        longer = (
            holders.join(others, ["set_id", "prefix"])
            .where("last < next")
            .select("set_id", "n", "bad", F.concat("prefix", F.array("last")).alias("prefix"), F.col("next").alias("last"))
        )
        counted = longer.groupBy("prefix", "last").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("bad") >= need)
        counted = written(counted.withColumn("rule_tokens", F.concat("prefix", F.array("last"))), "counted")
        # Items are distinct, so this leaves out one at a time.
        without = F.transform("rule_tokens", lambda x: F.array_remove("rule_tokens", x))
        surer = (
            counted.select("rule_tokens", good.alias("good"), F.explode(without).alias("part"))
            .join(parts, "part")
            .where("good < part_good")
            .groupBy("rule_tokens")
            .agg(F.count(F.lit(1)).alias("parts"))
            .where(F.col("parts") == F.size("rule_tokens"))
        )
        kept = written(counted.join(surer.select("rule_tokens"), "rule_tokens"), "level")
        levels.append(kept.select("rule_tokens", "n", "bad"))
        going_on = kept.where("bad < n")
        # These have len(levels) + 1 items; a longer one has one part more than that.
        if going_on.count() < len(levels) + 2:
            return reduce(DataFrame.unionByName, levels)
        parts = going_on.select(F.col("rule_tokens").alias("part"), good.alias("part_good"))
        holders = written(longer.join(going_on.select("prefix", "last"), ["prefix", "last"], "left_semi"), "holders")


def _anchored(combined: DataFrame, items: DataFrame) -> DataFrame:
    """Combinations with their rarest item: rule_tokens, anchor."""
    return (
        combined.select("rule_tokens", F.explode("rule_tokens").alias("item"))
        .join(items, "item")
        .groupBy("rule_tokens")
        .agg(F.min_by("item", F.struct("n", "item")).alias("anchor"))
    )


def _contained(holders: DataFrame, items: str, rules: DataFrame) -> DataFrame:
    """Pairs of a holder and a rule that its array ``items`` contains whole, found by the rule's anchor."""
    looked_up = holders.withColumn("anchor", F.explode(items)).join(rules, "anchor")
    return looked_up.where(F.size(F.array_except("rule_tokens", items)) == 0)


def matches(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Token sets (distinct ``tokens``) that contain a rule: tokens, confidence and tokens of the surest rule."""
    return (
        _contained(token_sets.select("tokens"), "tokens", rules)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", "rule_tokens")).alias("best"))
        .select("tokens", "best.confidence", "best.rule_tokens")
    )


def fired(token_sets: DataFrame, mined: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    """Distinct ``tokens`` that a mined rule blocks: tokens, confidence, and the set's own tokens that make the rule."""
    if mined is None:
        empty = "tokens array<string>, confidence double, rule_tokens array<string>"
        return token_sets.sparkSession.createDataFrame([], empty)
    rules, members = mined
    held = (
        token_sets.select("tokens", F.explode("tokens").alias("token"))
        .join(members, "token")
        .groupBy("tokens")
        .agg(F.collect_list(F.struct("item", "token")).alias("held"))
        .withColumn("items", F.array_distinct(F.transform("held", lambda x: x["item"])))
    )
    own = F.transform(
        "rule_tokens",
        lambda i: F.array_min(F.transform(F.filter("held", lambda x: x["item"] == i), lambda x: x["token"])),
    )
    return (
        _contained(held, "items", rules)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", F.array_sort(own).alias("rule_tokens"))).alias("best"))
        .select("tokens", "best.confidence", "best.rule_tokens")
    )


def judge(pages: DataFrame, labels: DataFrame, rules=GIVEN_RULES) -> DataFrame:
    """Verdict on every page: page_id, host, path, rule, verdict, mined_rule, confidence.

    ``labels`` has doc_id and quality; the label of a page is that of its own id, and quality 0 is bad. Repeated
    pages are judged alike, one row each.
    """
    url = F.col("url")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"))
    known = (
        labels.where("quality is not null")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg((F.count_if(F.col("quality") == 0) > 0).alias("bad"))
    )
    mined = mine(rows.join(known, "page_id").where(F.size("tokens") > 0).select("tokens", "bad"))
    given = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("given", given)
    rest = ruled.where("given is null").select("tokens").distinct()
    blocked = written(fired(rest, mined), "fired")
    return ruled.join(blocked, "tokens", "left").select(
        "page_id",
        "host",
        "path",
        F.col("given.rule").alias("rule"),
        F.coalesce(
            F.col("given.verdict"), F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        F.when(F.col("given").isNull(), F.array_join("rule_tokens", " ")).alias("mined_rule"),
        F.when(F.col("given").isNull(), F.col("confidence")).alias("confidence"),
    )

"""Jaccard similarity join of documents on word five-grams, by MinHash banding and exact verification.

* A text's set has its runs of five consecutive words (white-space separated, unchanged); of one to four words, all of
  them as one. Texts with equal sets are one *node* from then on, with a multiplicity, however many they are.
* Bands and rows follow from the threshold and a target recall. Nodes are shuffled on band hashes; each node is
  linked to the least of its bucket only, so a bucket of any size gives as many rows as it has nodes.
* The connected groups of these links hold all pairs that share a bucket. A group is verified pair by pair on the full
  sets; large groups are dealt to blocks, and every pair of blocks is a unit of bounded size. A unit returns
  the number of links of each node and a forest of its links, never the pairs.
* Classes are the connected groups of the verified links.

A row without words, or with a null id, links with nothing. Rows that repeat an id count as documents of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.spread import written
from tidemark.llm.words import Prefix, Words, mix, sliced_words

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 160
# A unit of verification has two blocks of at most about so many nodes and shingles.
BLOCK_NODES = 512
BLOCK_SHINGLES = 400_000
COLUMNS = 4096


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows per band, and with them the fewest bands, that find a pair at the threshold with this probability."""
    best = None
    for rows in range(1, most + 1):
        agree = threshold**rows
        if agree < 1e-12:
            break
        bands = 1 if agree >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-agree))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hash functions")
    return best


# ---------------------------------------------------------------- sets and signatures


def shingles(found: Words, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each document, sorted, and where each document's begin and the last one's end."""
    counts = np.where(found.counts > 0, np.maximum(found.counts - n + 1, 1), 0)
    document = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(found.first[:-1], counts)
    end = np.minimum(start + n, found.first[1:][document])
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    keys = Prefix(found.hashes(0), 0).spans(start, end)
    order = np.lexsort((keys, document))
    keys, document = keys[order], document[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (document[1:] != document[:-1])
    keys, document = keys[new], document[new]
    return keys, np.searchsorted(document, np.arange(len(counts) + 1))


def set_names(keys: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """128-bit names of sets of shingles."""
    halves = [Prefix(mix(keys + np.uint64(seed)), seed).spans(edges[:-1], edges[1:]) for seed in (0, 1)]
    return [a + b for a, b in zip(*[[x.tobytes() for x in half] for half in halves])]


def signatures(keys: np.ndarray, edges: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes, a row per document with shingles."""
    low = (keys >> np.uint64(32)).astype(np.uint32)
    factors = (mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (mix(np.arange(7001, 7001 + bands * rows, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
    some = edges[:-1][edges[:-1] < edges[1:]]
    found = np.empty((len(some), bands), np.uint64)
    for band in range(bands):
        name = np.full(len(some), band + 1, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            name = mix(name + np.minimum.reduceat(low * factors[i] + shifts[i], some))
        found[:, band] = name
    return found


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, set_name, shingles (their number) and bands. Without words or id: null name and bands."""

    def run(batches):
        for batch in batches:
            names, counts, hashes = [], [], []
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for lo, hi, found in sliced_words(batch.column("text")):
                keys, edges = shingles(found)
                own = np.diff(edges)
                some = (own > 0) & known[lo:hi]
                names += [n if ok else None for n, ok in zip(set_names(keys, edges), some)]
                counts.append(own)
                matrix = np.zeros((hi - lo, bands), np.uint64)
                if (own > 0).any():
                    matrix[own > 0] = signatures(keys, edges, bands, rows)
                hashes += [row if ok else None for row, ok in zip(matrix.view(np.int64), some)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.binary()),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["doc_id", "set_name", "shingles", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, set_name binary, shingles long, bands array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- verification


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs of sets are similar; with ``right`` None, pairs within ``left``. Sets are distinct sorted keys."""
    every = left if right is None else left + right
    sizes = np.array([len(s) for s in every], float)
    keys = np.concatenate(every)
    document = np.repeat(np.arange(len(every)), [len(s) for s in every])
    order = np.argsort(keys, kind="stable")
    keys, document = keys[order], document[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    column = np.cumsum(new) - 1
    # A shingle of one set only is in no intersection.
    often = np.bincount(column)[column] > 1
    column, document = np.unique(column[often], return_inverse=True)[1], document[often]
    split = len(left)
    n_right = len(every) if right is None else len(right)
    common = np.zeros((split, n_right), np.float32)
    width = int(column.max()) + 1 if len(column) else 0
    edges = np.searchsorted(column, np.arange(0, width + COLUMNS, COLUMNS))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = np.zeros((len(every), COLUMNS), np.float32)
        part[document[lo:hi], column[lo:hi] - k * COLUMNS] = 1
        common += part[:split] @ (part if right is None else part[split:]).T
    sizes_right = sizes if right is None else sizes[split:]
    together = sizes[:split, None] + sizes_right[None, :] - common
    found = common >= threshold * together - 1e-9
    if right is None:
        np.fill_diagonal(found, False)
    return found


def forest(found: np.ndarray) -> np.ndarray:
    """For each node of a square link matrix the least node it is connected with."""
    label = np.arange(len(found))
    while True:
        least = np.where(found, label[None, :], len(label)).min(1, initial=len(label))
        new = np.minimum(label, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _square(found: np.ndarray) -> np.ndarray:
    n, m = found.shape
    whole = np.zeros((n + m, n + m), bool)
    whole[:n, n:], whole[n:, :n] = found, found.T
    return whole


LINKS = "node long, links long, least long"


def _verify(threshold: float):
    def of_unit(table: pa.Table) -> pa.Table:
        sets: list[np.ndarray] = []
        right_set = np.zeros(table.num_rows, bool)
        expected = table.column("set_name").to_pylist()
        for lo, _hi, found in sliced_words(table.column("text")):
            keys, edges = shingles(found)
            for i, name in enumerate(set_names(keys, edges)):
                sets.append(keys[edges[i] : edges[i + 1]])
                right_set[lo + i] = name == expected[lo + i]
        node = table.column("node").to_numpy()
        # Of rows that repeat an id, the one whose set is the node's; once.
        _, once = np.unique(np.where(right_set, node, -1), return_index=True)
        chosen = once[right_set[once]]
        group = table.column("component").to_numpy()
        block = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        copies = table.column("copies").to_numpy()
        rows = [np.zeros((3, 0), np.int64)]
        order = chosen[np.argsort(group[chosen], kind="stable")]
        for own in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            own = own[np.argsort(node[own])]
            if len(own) < 2:
                continue
            if i == j:
                found = linked([sets[k] for k in own], None, threshold)
            else:
                a, b = own[block[own] == i], own[block[own] == j]
                if not len(a) or not len(b):
                    continue
                found = _square(linked([sets[k] for k in a], [sets[k] for k in b], threshold))
                own = np.concatenate([a, b])
            some = found.any(1)
            links = found @ copies[own].astype(np.int64)
            rows.append(np.stack([node[own], links, node[own][forest(found)]])[:, some])
        made = np.concatenate(rows, 1)
        return pa.table({"node": made[0], "links": made[1], "least": made[2]})

    return of_unit


def verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Links and least connected node per node and unit. ``groups``: node and component."""
    members = written(
        nodes.select("node", "doc_id", "set_name", "copies", "shingles").join(
            groups.withColumnRenamed("component", "own"), "node"
        ).withColumnRenamed("own", "component"),
        "members",
    )
    sizes = written(
        members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum("shingles").alias("amount")), "sizes"
    )
    total = members.agg(F.sum("shingles")).first()[0] or 0
    buckets = 1 + total // BLOCK_SHINGLES
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_NODES), F.ceil(F.col("amount") / BLOCK_SHINGLES)).cast("int")
    dealt = (
        members.join(sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "set_name",
            "copies",
            "component",
            "block",
            F.col("doc_id").alias("id"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(buckets)))
            .otherwise(F.col("component"))
            .alias("unit"),
            F.when(F.col("blocks") == 1, -1).otherwise(F.least("block", "with")).alias("i"),
            F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("block", "with")).alias("j"),
        )
    )
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return dealt.join(texts, "id").groupBy("unit", "i", "j").applyInArrow(_verify(threshold), LINKS)


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (the least id of the class) and n_links (other documents of at least this similarity)."""
    bands, rows = bands_and_rows(threshold, recall)
    rows_signed = written(signed(docs, bands, rows), "signatures")
    nodes = written(
        rows_signed.where("set_name is not null")
        .groupBy("set_name")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("shingles").alias("shingles"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(
        buckets.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets"
    )
    candidates = buckets.join(shared, "band").where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    links = written(verified(docs, nodes, components(candidates), threshold), "links")
    joined = components(links.select(F.col("least").alias("a"), F.col("node").alias("b")))
    least_id = (
        joined.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    )
    by_set = written(
        nodes.select("node", "set_name", "copies", "doc_id")
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(joined.join(least_id, "component").select("node", "class_id"), "node", "left")
        .select(
            "set_name",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "classes",
    )
    return (
        rows_signed.select("doc_id", "set_name")
        .join(by_set, "set_name", "left")
        .select(
            "doc_id",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )

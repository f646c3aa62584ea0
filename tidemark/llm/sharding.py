"""Shards by a hierarchical weighted hash tree, in column expressions only.

A topology is a tree: regions of racks of shards, each shard with a weight. A key descends it: at each level
every child draws ``-ln(u) / weight`` with ``u`` from a hash of the key and the child's path, and the least draw
wins. The weight of a rack or region is the sum of its shards' weights. A draw depends on nothing but the key, the
path and the weight, so

* a child wins with a probability in proportion to its weight;
* where a weight changes, keys move only between that child and its siblings, and below a node none of whose
  weights changed, nothing moves;
* a new shard that comes as a region of its own takes keys only into itself.

Null keys count as one key value. Repeated rows get the same shard and different slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import numbered, written

Topology = dict[str, dict[str, dict[int, float]]]

SHARDS = 24
OVERHEAD_BYTES = 8


def topology(regions: int = 2, racks: int = 3, shards: int = 4, weight: float = 1.0) -> Topology:
    """An even tree; shards are numbered from 0."""
    return {
        f"region{r}": {
            f"rack{k}": {(r * racks + k) * shards + s: weight for s in range(shards)} for k in range(racks)
        }
        for r in range(regions)
    }


def grown(tree: Topology, weight: float = 1.0) -> Topology:
    """The tree with one more shard, in a region of its own, so that no other subtree changes its weight."""
    shard = 1 + max(s for region in tree.values() for rack in region.values() for s in rack)
    return tree | {f"region{len(tree)}": {"rack0": {shard: weight}}}


def _children(tree: Topology) -> dict[str, dict[str, float]]:
    """For the root (an empty path), each region and each rack: its children's paths and weights."""
    found: dict[str, dict[str, float]] = {"": {}}
    for r, region in tree.items():
        found[r] = {f"{r}/{k}": sum(rack.values()) for k, rack in region.items()}
        found[""][r] = sum(found[r].values())
        for k, rack in region.items():
            found[f"{r}/{k}"] = {f"{r}/{k}/{s}": w for s, w in rack.items()}
    able = {node: {c: float(w) for c, w in below.items() if w > 0} for node, below in found.items()}
    if not able[""]:
        raise ValueError("the topology has no weight")
    return able


def _literal_map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[c for key, value in entries.items() for c in (F.lit(key), value)])


def with_shard(df: DataFrame, keys: list[str], tree: Topology, name: str = "shard") -> DataFrame:
    """Adds the shard of each row. Equal draws go to the first path."""
    columns = [F.col(k) for k in keys]

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*columns, child["path"]), 11)
        uniform = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["path"].alias("path"))

    below = _literal_map(
        {
            node: F.array(*[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight")) for c, w in children.items()])
            for node, children in _children(tree).items()
            if children
        }
    )
    node = F.lit("")
    for _level in ("region", "rack", "shard"):
        node = F.array_min(F.transform(F.element_at(below, node), draw))["path"]
    return df.withColumn(name, F.element_at(F.split(node, "/"), -1).cast("int"))


def assign(docs: DataFrame, tree: Topology, larger: Topology | None = None) -> DataFrame:
    """Shard and slot of each document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's bytes and a fixed overhead; a null text has none. The law is ``key``: the id and the
    tree decide. ``larger`` (by default one more shard) gives ``grown_shard``. Slots are gapless in a shard; they
    are numbered in buckets, since a shard of a large table is too much for one task.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = with_shard(rows, ["doc_id"], tree)
    placed = with_shard(placed, ["doc_id"], larger or grown(tree), "grown_shard")
    table = written(placed, "shards")
    order = ["doc_id", "text_crc32", "size"]
    return numbered(table, ["shard"], order, order, "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )

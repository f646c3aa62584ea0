import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from corpus_helpers import table

from tidemark.llm import queries, sharding


def brute(doc_id, tree):
    """The shard by the same draws, in Python."""

    def draw(path, weight):
        seed = 42 if doc_id is None else xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
        bits = xxhash.xxh64_intdigest(path.encode(), seed) >> 11
        return -math.log((bits + 0.5) / 2**53) / weight

    def weight(x):
        return sum(map(weight, x.values())) if isinstance(x, dict) else x

    path, level = "", tree
    while isinstance(level, dict):
        able = {f"{path}/{k}".lstrip("/"): v for k, v in level.items() if weight(v) > 0}
        path = min(able, key=lambda p: (draw(p, weight(able[p])), p))
        level = able[path]
    return int(path.rpartition("/")[2])


def test_odd_rows(odd_docs, odd_rows, no_docs):
    tree = sharding.topology()
    found = sharding.assign(odd_docs, tree).collect()
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in found), key=repr)
    expected = [
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute(i, tree), brute(i, sharding.grown(tree)))
        for i, t in odd_rows
    ]
    assert got == sorted(expected, key=repr)
    assert sharding.assign(no_docs, tree).count() == 0


def test_query(spark, sf_dir):
    found = queries.queries()["op7_hash_tree_sharding"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    tree, slots = sharding.topology(), defaultdict(list)
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")
        assert r["shard"] == brute(r["doc_id"], tree) and r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r["grown_shard"] == 24 for r in found)


def test_shares_follow_the_weights_and_moves_stay_in_the_subtree(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = {"a": {"x": {0: 1.0, 1: 3.0}, "y": {2: 2.0}}, "b": {"z": {3: 4.0, 4: 0.0, 5: 2.0}}}
    heavier = {**tree, "b": {"z": {3: 4.0, 4: 0.0, 5: 5.0}}}
    both = sharding.with_shard(sharding.with_shard(keys, ["doc_id"], tree), ["doc_id"], heavier, "after").collect()
    share = Counter(r["shard"] for r in both)
    assert all(abs(share[s] / 20_000 - w / 12) < 0.015 for s, w in ((0, 1), (1, 3), (2, 2), (3, 4), (5, 2)))
    # Of the unchanged region a, rows only leave, and none moves within it.
    assert all(r["after"] == r["shard"] or r["after"] in (3, 5) for r in both)
    assert not any(r["shard"] == 5 and r["after"] != 5 for r in both)


def test_no_weight_is_refused(spark):
    with pytest.raises(ValueError):
        sharding.with_shard(spark.range(1), ["id"], {"a": {"x": {0: 0.0}}})


def test_numbers_are_gapless_in_a_large_group(spark, monkeypatch):
    from tidemark.llm import spread

    monkeypatch.setattr(spread, "ROWS_PER_BUCKET", 10)
    rows = spark.range(3000).selectExpr("id", "if(id % 10 < 8, 'hot', cast(id % 7 as string)) AS g")
    got = defaultdict(list)
    for r in spread.numbered(rows, ["g"], ["id"], ["id"], "number").collect():
        got[r["g"]].append(r["number"])
    assert all(sorted(n) == list(range(len(n))) for n in got.values()) and len(got["hot"]) == 2400

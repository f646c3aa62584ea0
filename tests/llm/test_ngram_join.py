import re
from collections import Counter, defaultdict

import pytest
from corpus_helpers import table, words

from tidemark.llm import ngram_join, queries
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, threshold=0.8):
    """(class_id, n_links) by row place; rows are (doc_id, text) with ids."""
    sets = []
    for _, text in rows:
        w = WORD.findall(text or "")
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    links = defaultdict(set)
    for k, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j > k).items():
            if n / (len(s) + len(sets[j]) - n) >= threshold:
                links[k].add(j)
                links[j].add(k)
    found = [None] * len(rows)
    for k in sorted(range(len(rows)), key=lambda k: rows[k][0]):
        if found[k] is None:
            todo = [k]
            while todo:
                x = todo.pop()
                if found[x] is None:
                    found[x] = (rows[k][0], len(links[x]))
                    todo += links[x]
    return found


def as_rows(df):
    return sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect() if r["doc_id"] is not None)


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows()
    assert bands * rows <= ngram_join.MOST_HASHES
    assert 1 - (1 - ngram_join.THRESHOLD**rows) ** bands >= ngram_join.RECALL
    with pytest.raises(ValueError):
        ngram_join.bands_and_rows(0.01, 0.999, 10)


def test_odd_rows(odd_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    expected = sorted((i, *found) for (i, _), found in zip(rows, brute(rows)))
    result = ngram_join.classes(odd_docs)
    assert as_rows(result) == expected
    assert [tuple(r) for r in result.where("doc_id IS NULL").collect()] == [(None, None, 0)]


def test_empty_table(no_docs):
    assert ngram_join.classes(no_docs).count() == 0


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 8)
    base = words(1, 120).split()
    rows = []
    for i in range(60):
        text = list(base)
        text[(7 * i) % 120] = f"edit{i % 20}"
        if i % 3:
            text[(11 * i) % 120] = "other"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, words(100 + i, 50)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted((i, *found) for (i, _), found in zip(rows, brute(rows)))
    assert as_rows(ngram_join.classes(docs)) == expected
    assert len({n for _, _, n in expected}) > 3


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    expected = sorted((i, *found) for (i, _), found in zip(rows, brute(rows)))
    assert as_rows(queries.queries()["op8_minhash_join"](spark, sf_dir)) == expected
    assert any(n for _, _, n in expected)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 120), (120, 110), (7, 7), (110, 100)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 110: 100, 120: 100}
    assert found.count() == len(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

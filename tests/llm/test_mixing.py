import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from corpus_helpers import table, words

from tidemark.llm import mixing, prefix, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), share=Fraction(3, 2), epochs=2):
    """(doc_id, source, text) to sorted (doc_id, source, size, source_size, target, taken)."""
    by_source = defaultdict(list)
    for i, source, text in rows:
        by_source[source].append((i, len(WORD.findall(text or ""))))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, n in by_source[s]) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    targets, full, total = {}, set(), share * sum(size.values())
    while True:
        rest = total - sum(epochs * size[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        targets = {s: Fraction(epochs * size[s]) if s in full else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if targets[s] > epochs * size[s]}
        if not above:
            break
        full |= above
    found = []
    for s in names:
        budget = int(targets[s] + Fraction(1, 2))

        def key(row):
            text = "" if row[0] is None else str(row[0])
            return hashlib.md5(f":{text}:{row[1]}".encode()).hexdigest(), row[0] is None

        before = 0
        for i, n in sorted(by_source[s], key=key):
            taken = sum(max(0, min(n, budget - before - e * size[s])) for e in range(epochs))
            found.append((i, s, n, size[s], float(targets[s]), taken))
            before += n
    return sorted(found, key=repr)


def mixed(df, **options):
    found = mixing.mix(df, **options)
    return sorted((tuple(r) for r in found.select("doc_id", "source", "size", "source_size", "target", "taken").collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "running", lambda *a: prefix.running(*a, rows=7))
    names = ["b", "a", None, "", "Ä", "zz", "c"]
    rows = [(i, names[(i * i + seed) % 7 if i % 3 else 0], words(i, i * 7 % 50)) for i in range(90)]
    rows += [(500 + k, "tiny", "one word") for k in range(3)] + [(600, "none", None), (601, "none", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixed(docs)
    assert [f[:4] + f[5:] for f in found] == [b[:4] + b[5:] for b in brute(rows)]
    assert [f[4] for f in found] == pytest.approx([b[4] for b in brute(rows)])


def test_budgets_are_met_to_the_word_and_no_document_more_than_twice(spark, sf_dir):
    found = mixed(table(spark, sf_dir, "documents"))
    taken, target = defaultdict(int), {}
    for _, source, size, _, wanted, got in found:
        taken[source] += got
        target[source] = wanted
        assert 0 <= got <= 2 * size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_a_third_of_all_rows_repeated(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 8)
    rows = [(7, "a", "x y z")] * 50 + [(i, "ab"[i % 2], words(i, 9)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert [f[:4] + f[5:] for f in mixed(docs)] == [b[:4] + b[5:] for b in brute(rows)]


def test_odd_rows_and_empty_table(odd_docs, odd_rows, no_docs):
    from pyspark.sql import functions as F

    found = mixed(odd_docs.withColumn("source", F.lit(None).cast("string")).withColumn("size", F.lit("!")))
    assert [f[:4] + f[5:] for f in found] == [b[:4] + b[5:] for b in brute([(i, None, t) for i, t in odd_rows])]
    assert mixed(no_docs.withColumn("source", F.lit("a"))) == []


def test_more_than_the_epochs_give_is_refused(odd_docs):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        mixing.mix(odd_docs.withColumn("source", F.lit("a")), share=(5, 2))


def test_query_gives_the_same_again(spark, sf_dir):
    runs = [queries.queries()["op11_prefix_mix"](spark, sf_dir).collect() for _ in range(2)]
    assert sorted(map(repr, runs[0])) == sorted(map(repr, runs[1]))

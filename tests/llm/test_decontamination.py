import re
from collections import Counter, defaultdict

import numpy as np
from corpus_helpers import table, words

from tidemark.llm import decontamination, queries

WORD = re.compile(r"[A-Za-z0-9'\x80-\U0010ffff]+")
ITEM = "Which river runs through the old town of Kraków and where does it reach the sea? The Vistula, at Gdańsk bay."


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(df):
    return sorted((r["doc_id"], r["item_id"]) for r in df.collect())


def test_whole_items_are_found_whatever_stands_around(spark):
    others = [words(1000 + k, 40) for k in range(50)]
    texts = [
        f"{words(7, 500)} {ITEM} {words(8, 300)}", ITEM.upper(), f"{words(9, 63)} {ITEM}", ITEM[:50],
        words(10, 800), ITEM.replace("river", "stream"), "the of and it the where " * 40, ITEM + " " + others[3],
    ]
    got = found(decontamination.leaks(docs(spark, *texts), items(spark, ITEM, *others)))
    assert got == [(0, 0), (1, 0), (2, 0), (5, 0), (7, 0), (7, 4)]


def test_odd_rows(spark, odd_docs, no_docs):
    one = items(spark, None, "", ITEM, "one", words(1, 90, 4000))
    got = decontamination.leaks(odd_docs, one)
    assert found(got) == [(4, 3), (5, 4), (6, 4)]
    kept = decontamination.clean(odd_docs, one)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 3
    assert decontamination.leaks(no_docs, one).count() == 0
    assert decontamination.leaks(odd_docs, one.limit(0)).count() == 0
    assert decontamination.clean(odd_docs, one.limit(0)).count() == odd_docs.count()


def test_many_items_make_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "INDEX_POSTINGS", 200)
    texts = [words(k, 30, 5000) for k in range(40)]
    few = items(spark, *texts)
    assert len(decontamination.indexes(few)) > 3
    got = decontamination.leaks(docs(spark, *[f"a b c {t} d e" for t in texts]), few)
    assert found(got) == [(k, k) for k in range(40)]


def test_pruning_loses_no_hit():
    """Block-max search against the sum of all postings."""
    rng = np.random.default_rng(1)
    some = [decontamination.Item(k, rng.zipf(1.3, 25).astype(np.uint64) % np.uint64(500)) for k in range(60)]
    df = Counter(t for i in some for t in set(i.words.tolist()))
    index = decontamination.Index(some, df, len(some), 25.0)
    words_ = np.concatenate([rng.zipf(1.3, 300).astype(np.uint64) % np.uint64(500), some[3].words, some[17].words])
    from tidemark.llm.words import Words

    n = len(words_)
    held = Words(np.zeros(0, np.uint8), np.arange(n), np.arange(n) + 1, np.array([0, n]), np.array([0, 0]))
    passage, item, score, _, start, end = decontamination.search(index, held, words_, 0.4)
    got = {(int(start[p]), int(i)): s for p, i, s in zip(passage, item, score)}
    expected = {}
    for a in range(0, max(1, n - index.stride), index.stride):
        terms = set(words_[a : a + 2 * index.stride].tolist())
        for k, one in enumerate(some):
            total = 0.0
            for t in terms & set(one.words.tolist()):
                place = int(np.searchsorted(index.terms, np.uint64(t)))
                own = slice(index.first[place], index.first[place + 1])
                total += float(index.part[own][index.item[own] == k].sum())
            if total >= 0.4:
                expected[a, k] = total
    assert set(got) == set(expected) and len(got) > 2
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_query(spark, sf_dir):
    held, grams = defaultdict(set), {}
    for r in table(spark, sf_dir, "benchmark").collect():
        w = WORD.findall(r["text"].lower())
        grams[r["item_id"]] = set(zip(w, w[1:], w[2:]))
        for g in grams[r["item_id"]]:
            held[g].add(r["item_id"])
    expected = []
    for r in table(spark, sf_dir, "documents").collect():
        w = WORD.findall(r["text"].lower())
        counts = Counter(i for g in set(zip(w, w[1:], w[2:])) for i in held.get(g, ()))
        expected += [(r["doc_id"], i) for i, n in counts.items() if n >= 0.6 * len(grams[i])]
    assert found(queries.queries()["op5_bm25_decontamination"](spark, sf_dir)) == sorted(expected) and expected


def test_hits_of_an_item_do_not_hang_on_other_items(spark):
    cut = ITEM.replace("? ", "? " + words(20, 15000) + " ", 1)
    texts = docs(spark, cut, f"{words(21, 300)} {ITEM}")
    alone = found(decontamination.leaks(texts, items(spark, ITEM)))
    assert alone == [(1, 0)]
    assert found(decontamination.leaks(texts, items(spark, ITEM, words(22, 20000)))) == alone


def test_long_items_in_long_documents(spark):
    long = [words(30 + k, n) for k, n in enumerate((64, 65, 128, 129, 1000))]
    texts = [f"{words(40, 777)} {text} {words(41, 333)}" for text in long]
    assert found(decontamination.leaks(docs(spark, *texts), items(spark, *long))) == [(k, k) for k in range(5)]


def test_length_classes(spark):
    made = decontamination.indexes(items(spark, *[words(50 + k, n) for k, n in enumerate((3, 64, 65, 128, 129, 256, 257))]))
    assert [(i.stride, sorted(len(x.words) for x in i.items)) for i in made] == [
        (64, [3, 64]), (128, [65, 128]), (256, [129, 256]), (512, [257])
    ]


def test_short_items_are_hit_by_documents_of_just_their_words(spark):
    short = items(spark, "one", "yes or no", "one two three four five", words(60, 20000))
    texts = docs(spark, f"{words(61, 40)} one {words(62, 9)}", "One.", "yes or no?", "yes or", "one two three four five six")
    assert found(decontamination.leaks(texts, short)) == [(1, 0), (2, 1)]
    assert {r["doc_id"] for r in decontamination.clean(texts, short).collect()} == {0, 3, 4}

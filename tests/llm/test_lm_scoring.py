import math
import re
from collections import Counter

from corpus_helpers import table, words

from tidemark.llm import lm_scoring, queries

WORD = re.compile(r"[A-Za-z0-9'\x80-\U0010ffff]+")
LATIN = {c: chr(c + 32) for c in range(0xC0, 0xDF) if c != 0xD7}


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), (text or "").translate(LATIN))
    return WORD.findall(lower)


def brute(texts, target, share=2e-6):
    """Loss pairs (target, background) of each text, from plain counts."""
    counted = [tokens(t) for t in texts]
    kept = [[w for own, t in zip(counted, target) if t for w in own], [w for own in counted for w in own]]
    uni = [Counter(k) for k in kept]
    totals = [len(k) for k in kept]
    vocabulary = {w for w, n in uni[1].items() if n >= share * totals[1] and n > 1}
    shown = [[w if w in vocabulary else None for w in own] for own in counted]
    pairs = [
        Counter(p for own, t in zip(shown, target) if t or which for p in zip(own, own[1:])) for which in (0, 1)
    ]
    all_pairs = sum(pairs[1].values())
    kept_pairs = {p for p, n in pairs[1].items() if n >= share * all_pairs and n > 1}
    uni = [{**{w: c[w] for w in vocabulary}, None: t - sum(c[w] for w in vocabulary)} for c, t in zip(uni, totals)]
    size = len(vocabulary) + 1
    mass = [Counter() for _ in uni]
    for k in (0, 1):
        for p in kept_pairs:
            mass[k][p[0]] += 0.7 * pairs[k][p] / max(uni[k][p[0]], 1)

    def loss(k, before, word, begins):
        own = (uni[k][word] + 0.5) / (totals[k] + 0.5 * size)
        if begins:
            return -math.log(own)
        rest = max(1 - mass[k][before], 0.3)
        after = 0.7 * pairs[k][before, word] / max(uni[k][before], 1) if (before, word) in kept_pairs else 0.0
        return -math.log(after + rest * own)

    found = []
    for own in shown:
        losses = [[loss(k, own[j - 1] if j else None, w, not j) for j, w in enumerate(own)] for k in (0, 1)]
        found.append([sum(x) / len(x) if x else None for x in losses])
    return found


def test_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    good = {r["doc_id"] for r in table(spark, sf_dir, "labels").where("quality = 1").collect()}
    expected = brute([r["text"] for r in rows], [r["doc_id"] in good for r in rows])
    found = {r["doc_id"]: r for r in queries.queries()["op4_cross_entropy_difference"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r, (target, background) in zip(rows, expected):
        got = found[r["doc_id"]]
        assert got["n_words"] == len(tokens(r["text"]))
        assert math.isclose(got["target_loss"], target, rel_tol=1e-9)
        assert math.isclose(got["background_loss"], background, rel_tol=1e-9)
        assert math.isclose(got["score"], target - background, abs_tol=1e-9)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, no_labels):
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, None), (8, 1), (11, 0)], "doc_id long, quality int")
    for known in (labels, no_labels.select("doc_id", "quality")):
        found = lm_scoring.score(odd_docs, known).collect()
        assert len(found) == len(odd_rows)
        for r in found:
            assert (r["target_loss"] is None) == (r["n_words"] == 0)
            assert math.isfinite(r["score"])
    assert lm_scoring.score(no_docs, labels).count() == 0


def test_least_count_is_the_same_at_every_size(spark):
    """Words and bigrams seen twice are known in a corpus of which they are less than 2e-6 as well."""
    texts = [words(seed, 100_000, 50) for seed in range(11)] + ["rare one here", "rare one there", None, "w1 rare w2 once"]
    target = [k % 3 == 0 for k in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(good)) for k, good in enumerate(target)], "doc_id long, quality int")
    expected = brute(texts, target, share=0)
    # Of one chunk per task, and of many.
    for found in (lm_scoring.score(docs, labels), lm_scoring.score(docs, labels, chunk_bytes=50_000, bucket_bytes=50_000)):
        found = {r["doc_id"]: r for r in found.collect()}
        assert len(found) == len(texts)
        for k, (loss_target, loss_background) in enumerate(expected):
            if loss_target is None:
                assert found[k]["target_loss"] is None and found[k]["score"] == 0
            else:
                assert math.isclose(found[k]["target_loss"], loss_target, rel_tol=1e-9)
                assert math.isclose(found[k]["background_loss"], loss_background, rel_tol=1e-9)

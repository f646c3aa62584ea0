import zlib

import numpy as np
import pytest
from corpus_helpers import table
from pyspark.sql import functions as F

from tidemark.llm import quality, queries, toxicity
from tidemark.llm.labelled import FIT_BYTES, fit_logistic, fit_sample
from tidemark.llm.words import WORD_BYTES
from tidemark.llm.words import words as split

OPERATORS = {"op2_crf_toxicity": (toxicity, "toxic", 4, 2), "op9_zstd_quality": (quality, "quality", 5, 0)}


@pytest.fixture(scope="module", params=list(OPERATORS))
def scored(request, spark, sf_dir):
    found = queries.queries()[request.param](spark, sf_dir)
    return request.param, {r["doc_id"]: r for r in found.collect()}


def test_queries_on_held_out_rows(spark, sf_dir, scored):
    name, rows = scored
    _, label, modulus, rest = OPERATORS[name]
    assert set(rows) == {r["doc_id"] for r in table(spark, sf_dir, "documents").collect()}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % modulus == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    labelled = [(r[label], rows[r["doc_id"]]) for r in table(spark, sf_dir, "labels").collect()]
    right = [y == r["predicted"] for y, r in labelled if r["held_out"]]
    assert np.mean(right) > 0.75


def test_labels_of_held_out_rows_are_never_learned(spark, sf_dir, scored):
    name, rows = scored
    module, label, modulus, rest = OPERATORS[name]
    held = F.crc32(F.col("doc_id").cast("string")) % modulus == rest
    turned = table(spark, sf_dir, "labels").withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    again = module.score(table(spark, sf_dir, "documents"), turned)
    assert all(abs(rows[r["doc_id"]]["score"] - r["score"]) < 1e-9 for r in again.collect())


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, odd_docs, odd_rows, no_docs, no_labels, module):
    labels = spark.createDataFrame(
        [(1, 0, 1), (2, 1, 0), (5, 1, 0), (6, 0, 1), (7, None, None), (8, 1, 1), (9, 0, 0), (11, 0, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, no_labels):
        found = module.score(odd_docs, known).collect()
        assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
        by_id = {}
        for r in found:
            assert by_id.setdefault(r["doc_id"], r["score"]) == r["score"]
        assert by_id[1] == by_id[2]
    assert module.score(no_docs, no_labels).count() == 0


def test_marginals_equal_a_sum_over_all_paths():
    rng = np.random.default_rng(2)
    steps = np.exp(rng.normal(size=(2, 2)))
    for lengths in ([1], [5], [3, 1, 6], [70, 2, 130]):
        n = sum(lengths)
        emission, first = rng.normal(size=n) * 3, np.zeros(n, bool)
        first[np.cumsum([0, *lengths[:-1]])] = True
        got = toxicity.marginals(emission, first, -0.7, steps)
        at = 0
        for length in lengths:
            own = emission[at : at + length]
            forward = [np.array([1.0, np.exp(-0.7 + own[0])])]
            for e in own[1:]:
                forward.append((forward[-1] @ steps) * [1, np.exp(e)])
            backward = [np.ones(2)]
            for e in own[:0:-1]:
                backward.append(steps @ (backward[-1] * [1, np.exp(e)]))
            both = np.array(forward) * np.array(backward[::-1])
            assert np.allclose(got[at : at + length], both[:, 1] / both.sum(1))
            at += length
    assert len(toxicity.marginals(np.zeros(0), np.zeros(0, bool), 0.0, steps)) == 0


def test_toxic_spans(spark):
    rows = []
    for i in range(80):
        said = f"you grubnak w{i} x{i % 7} flimworp w{i % 11} " if i % 2 else f"nothing w{i} else x{i % 7} to say w{i % 11} "
        rows.append((i, f"fine words here number {i} {said} the end {i}"))
    docs = spark.createDataFrame([*rows, (500, "Ünder GRUBNAK flimworp, ok")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert all(found[i]["predicted"] == i % 2 for i in range(80))
    text = "Ünder GRUBNAK flimworp, ok".encode()
    spans = [text[s["start"] : s["end"]].decode() for s in found[500]["spans"]]
    assert spans == ["GRUBNAK flimworp"] and found[500]["predicted"] == 1
    assert all(not found[i]["spans"] for i in range(0, 80, 2))


def test_features_see_beginnings():
    text = b"grubnakeria grubnakeriot"
    rows = toxicity.features(split(np.frombuffer(text, np.uint8), np.array([0, len(text)]), WORD_BYTES))
    assert rows[0, 0] != rows[1, 0] and (rows[0, 1:] == rows[1, 1:]).all()


def test_logistic():
    x = np.linspace(-3, 3, 400)[:, None]
    y = (np.random.default_rng(0).random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    slope, intercept = fit_logistic(x, y, np.ones(400))
    assert abs(slope - 2) < 0.6 and abs(intercept + 1) < 0.5


def test_few_samples_make_a_dictionary():
    assert quality.dictionary([b"abc", b"def"])


def test_fit_sample_is_bounded_by_texts(spark):
    """Repeated ids, long and missing documents neither swell the sample nor take places in it."""
    long = "w " * FIT_BYTES
    rows = [(i, long) for i in range(40)] + [(100, f"copy {i % 3}") for i in range(300)] + [(i, f"t{i}") for i in range(101, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = [(i, i % 2) for i in [*range(40), *range(100, 130), *range(500, 540)]] + [(100, 0), (100, 0), (101, 1), (101, 0)]
    labels = spark.createDataFrame(known, "doc_id long, toxic int")

    def learnable(i):
        return zlib.crc32(str(i).encode()) % 4 != 2

    all_of, counts = fit_sample(docs, labels, "toxic", 4, 2, {0: 1000, 1: 1000})
    expected = {(i, "copy 0" if i == 100 else f"t{i}", y) for i, y in known if 100 <= i < 130 and learnable(i)}
    assert sorted(zip(all_of["doc_id"], all_of["text"], all_of["label"])) == sorted(expected)
    assert counts == {y: len({i for i, v in known if v == y and learnable(i)}) for y in (0, 1)}
    few, _ = fit_sample(docs, labels, "toxic", 4, 2, {0: 3, 1: 5})
    assert few["label"].value_counts().to_dict() == {0: 3, 1: 5}
    assert set(zip(few["doc_id"], few["label"])) <= {(i, y) for i, _t, y in expected}


def test_more_toxic_rows_admit_rarer_forms():
    assert [toxicity.enough_contexts(n) for n in (0, 100, 400, 800, 2000, 50_000)] == [3, 3, 6, 12, 12, 12]

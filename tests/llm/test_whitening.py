import math
import random

import numpy as np
import pytest
from corpus_helpers import table

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=4):
    """(vec_id, vector) to x, n, deviation, |whitened| and explained by numpy on exact whole numbers."""
    kept = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v]))
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    found = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = (np.array(x) - np.array(sums) / n) @ axes[:, order] / np.sqrt(values[order])
        found.setdefault(i, []).append((n, deviation, np.abs(w), values[order] / values.sum()))
    return found


def check(found, rows):
    expected = brute(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert {i: len(r) for i, r in by_id.items()} == {i: 4 * len(e) for i, e in expected.items()}
    for i, own in by_id.items():
        n, deviation, w, explained = expected[i][0]
        assert {(r["n"], r["deviation"]) for r in own} == {(n, deviation)}
        for r in own:
            k = r["component"] - 1
            assert abs(r["whitened"]) == pytest.approx(w[k], rel=1e-6, abs=1e-6)
            assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
            assert r["identity_error"] < 1e-9


def some(n, d=6, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + k) / 4 for k in range(d)]) for i in range(n)]


def test_equals_numpy_over_many_blocks(spark, monkeypatch):
    for name, value in (("ROWS_PER_BLOCK", 16), ("COLUMNS_PER_BLOCK", 4), ("BLOCKS_PER_TASK", 2)):
        monkeypatch.setattr(whitening, name, value)
    rows = some(200)
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    check(whitening.whiten(docs).collect(), rows)


def test_odd_rows(spark):
    rows = some(30)
    nan, inf = float("nan"), float("inf")
    odd = [
        (100, None), (101, []), (102, [None] * 6), (103, [nan] + [0.0] * 5), (104, [-inf] + [0.0] * 5),
        (105, [-0.0] * 6), (106, [0.0] * 6), (None, rows[3][1]), (7, rows[7][1]),
    ]
    short = [(200, [0.5] * 5)]
    frame = spark.createDataFrame([(*r, "!", "!") for r in rows + odd + short], "vec_id long, embedding array<float>, x string, index string")
    check(whitening.whiten(frame).collect(), rows + odd)


def test_signs_are_the_same_for_all_rows(spark):
    rows = some(60, seed=2)
    found = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    w = np.zeros((60, 4))
    for r in found:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(w.T @ w / 60 - np.eye(4)).max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))
    assert found.count() == 0 and found.columns == [f.split()[0] for f in whitening.SCHEMA.split(", ")]


def test_fewer_components_than_asked(spark):
    rows = [(i, [i / 8, i / 4, 0.5]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1)


def test_entries_and_deviations_without_end(spark):
    rows = [(i, [float(np.float32(10.0**e)), i / 2]) for i, e in enumerate((30, 20, 1, 2, -5))]
    found = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert len({r["vec_id"] for r in found}) == 5


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    check(queries.queries()["op13_block_whitening"](spark, sf_dir).collect(), rows)

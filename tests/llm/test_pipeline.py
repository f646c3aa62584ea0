import corpus_pipeline
from corpus_helpers import table, words
from test_ngram_join import brute as near
from test_packing import check
from test_substring_dedup import brute as cut

from tidemark.llm import decontamination, quality
from tidemark.llm.spread import written


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages_against_brute_force(spark, sf_dir):
    """Every stage against plain Python on what the stage before kept."""
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    labels, items = table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality_classifier", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "packing",
    ]

    kept = written(stages["quality_classifier"](spark, docs, sf_dir), "t")
    good = quality.score(docs, labels).where("predicted = 1").select("doc_id")
    assert kept.columns == columns and pairs(kept) == pairs(docs.join(good, "doc_id", "left_semi"))
    assert kept.count() < docs.count()

    before = pairs(kept)
    kept = written(stages["ngram_jaccard_join"](spark, kept, sf_dir), "t")
    first = {i for (i, _), (least, _) in zip(before, near(before)) if i == least}
    assert kept.columns == columns and pairs(kept) == [p for p in before if p[0] in first]
    assert len(first) < len(before)

    before = pairs(kept)
    kept = written(stages["substring_dedup"](spark, kept, sf_dir), "t")
    expected = [(i, text if not removed else left) for (i, text), (_, removed, left) in zip(before, cut(before))]
    assert kept.columns == columns and pairs(kept) == sorted(expected, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())

    before = pairs(kept)
    kept = written(stages["benchmark_decontamination"](spark, kept, sf_dir), "t")
    leaking = {r["doc_id"] for r in decontamination.leaks(spark.createDataFrame(before, "doc_id long, text string"), items).collect()}
    assert kept.columns == columns and pairs(kept) == [p for p in before if p[0] not in leaking] and leaking

    before = pairs(kept)
    assert check([r.asDict() for r in stages["packing"](spark, kept, sf_dir).collect()], before, 4096) > 0.9


def test_odd_rows_and_empty_tables_pass(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = written(stage(spark, docs, sf_dir), name)
            if name != "packing":
                assert made.columns == odd_docs.columns
                docs = made
        assert (made.count() > 0) == (docs.count() > 0)


def test_near_duplicates_are_dropped_by_row_and_not_by_id(spark, sf_dir):
    a, b, c = words(1, 80), words(2, 80), words(3, 80)
    rows = [(7, a), (7, a), (7, a), (None, b), (None, b), (9, a), (9, c), (3, None), (3, None), (4, ""), (11, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'!' AS row", "1 AS class_id")
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    kept = stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    expected = [(7, a), (11, b), (9, c), (3, None), (3, None), (4, "")]
    assert pairs(kept) == sorted(expected, key=repr)

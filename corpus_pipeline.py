"""The corpus pipeline: each stage takes what its predecessor kept and writes what it keeps.

Stages take (spark, docs, sf_dir). All but the last return the columns of ``documents``. Of repeated rows one is
kept; empty tables go through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, ngram_join, packing, quality, substring_dedup
from tidemark.llm.spread import importable, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the compression classifier rejects."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near copies: that with the least id, a null id last. Rows are told apart by a written
    number, so of repeated rows one stays, and a row does not go for another that has its id."""
    importable(spark)
    row = "row"
    while row in docs.columns:
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = ngram_join.classes(rows.select(F.col(row).alias("doc_id"), "text")).where("n_links > 0")
    members = found.select(F.col("doc_id").alias(row), "class_id").join(rows.select(row, "doc_id"), row)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    first = members.groupBy("class_id").agg(F.min(rank)[row].alias(row))
    later = written(members.select(row).join(first.select(row), row, "left_anti"), "later")
    return rows.join(later, row, "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of an earlier document. A text that loses nothing stays as it is; one that loses words has the words
    left, joined by one space, and its new number of characters."""
    importable(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = substring_dedup.dedup(docs, carry=others)
    cut = F.col("n_removed") > 0
    columns = {
        "doc_id": F.col("doc_id"),
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
        **{c: F.col("carried")[c] for c in others},
    }
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(cut, F.length("kept_text").cast(kind)).otherwise(F.col("carried")["n_chars"])
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents left and their places in sequences."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("packing", packed),
]

# Training, hashing and tokenising are not SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written result of the one before."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = written(docs, name)
    return docs

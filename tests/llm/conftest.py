from pathlib import Path

import pytest
from corpus_helpers import words
from pyspark.sql import functions as F

from tidemark.llm.spread import importable

SF = Path("/root/testdata/sf0.001")

# Names that the operators use inside.
CLASHING = ("score", "chunk", "node", "carried", "_bucket", "label", "anchor", "set_name", "tokens", "id")


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def sf_dir():
    if not SF.is_dir():
        pytest.skip("no test tables")
    return str(SF)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, blanks, one word, long and repeated texts, a null id, a repeated row, other scripts."""
    long, some = words(1, 30_000, 4000), words(2, 300)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long), (7, some), (8, some), (8, some),
        (9, "x " + some + " y"), (None, some), (10, "ÄÖÜ ñandú Élan  naïve\x1c日本 語"), (11, "a " * 700), (12, "a " * 700),
        (13, "a " * 699 + "b"), (14, "." * 5000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("!"))
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


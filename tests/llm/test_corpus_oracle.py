"""Every corpus query that has SQL against it, on the smallest test tables."""

import os
from pathlib import Path

import duckdb
import pytest

from tidemark.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, database, name):
    found = queries.queries()[name](spark, SF_DIR)
    expected = database.execute(queries.oracle_sql()[name])
    names = sorted(d[0] for d in expected.description)
    assert names == sorted(found.columns)
    reference = [tuple(r) for r in expected.df()[names].astype(object).itertuples(index=False, name=None)]
    rows = [tuple(r) for r in found.select(*names).toPandas().astype(object).itertuples(index=False, name=None)]
    assert sorted(rows, key=repr) == sorted(reference, key=repr)
    assert rows

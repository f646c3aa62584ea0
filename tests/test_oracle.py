"""Every registered query against its SQL, on the smallest test tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def table(df):
    """Columns by name, rows in a fixed order, missing values as None."""

    def value(v):
        if v is None or v != v or (isinstance(v, float) and math.isnan(v)):
            return None
        return v

    names = sorted(df.columns)
    records = df[names].astype(object).itertuples(index=False, name=None)
    return names, sorted((tuple(value(v) for v in record) for record in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(contract.payment_queries()) == set(contract.payment_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.payment_queries()))
def test_query(spark, database, name):
    found = contract.payment_queries()[name](spark, SF_DIR)
    expected = database.execute(contract.payment_sql()[name])
    kinds = {"int64": "BIGINT", "bool": "BOOLEAN", "float64": "DOUBLE"}
    result = found.toPandas()
    reference = expected.df()
    assert table(result) == table(reference)
    for column in result.columns:
        if str(reference[column].dtype) in kinds:
            assert result[column].dtype == reference[column].dtype
    assert len(result) > 0


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["payment_type", "transaction_count", "total_amount", "avg_amount", "snapshot_time"]
    assert found.count() == 4

"""Every registered query against its SQL counterpart, and its plan, at the smallest scale."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as contract
from check import differences, open_tables

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not here")


@pytest.fixture(scope="module")
def db():
    return open_tables(SF_DIR)


@pytest.fixture
def plans(monkeypatch):
    """The plans of all stages that a query writes on its way."""
    found, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        found.append(self._df._jdf.queryExecution().toString())
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return found


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, plans, name):
    frame = contract.queries()[name](spark, SF_DIR)
    got = [tuple(row) for row in frame.collect()]
    assert got
    for plan in [*plans, frame._jdf.queryExecution().toString()]:
        for quadratic in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join Cross"):
            assert quadratic not in plan
    sql = contract.oracle_sql().get(name)
    if sql:
        assert differences(frame, got, db, sql) == []


def test_oracle_names_are_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["term", "total", "rank"] and frame.count() > 0

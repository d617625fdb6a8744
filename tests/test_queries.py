"""Every registered query against its SQL on the small tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract
import oracle_queries
from compare import TABLES, sorted_rows
from tributary.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_queries.QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, SF)
    got = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(contract.oracle_sql()[name])
    expected = sorted_rows([c[0] for c in result.description], result.fetchall())
    assert got == expected
    assert len(got[1]) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0

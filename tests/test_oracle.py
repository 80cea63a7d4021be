"""Every registered query against its SQL on whole tables."""

import pytest
from compare import connect, oracle_rows, spark_rows

import __spark_entry__ as contract
from tidemark.plans.catalog import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, db, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = oracle_rows(db, ORACLE[name])
    assert names == expected_names
    assert len(rows) == len(expected) > 0
    assert rows == expected


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "pid"
    assert result.count() > 0

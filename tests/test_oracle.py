"""Every registered query against its SQL counterpart, types and values."""

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as contract
from tripstrata.catalog import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_the_comparison_notices_a_changed_value(spark, con):
    query = contract.queries()["filter_positive"]
    off = "SELECT * REPLACE (c_acctbal + CAST(c_custkey = 1 AS INT) AS c_acctbal) FROM customer"
    assert differences(spark, con, query, f"{off} WHERE c_acctbal > 0", SF_DIR)
    assert differences(spark, con, query, "SELECT * FROM customer WHERE c_acctbal > 100", SF_DIR)


def test_smoke_query_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.filterwarnings("ignore:columns not found")
@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert differences(spark, con, query, sql, SF_DIR) == []

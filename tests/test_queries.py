"""Every registered query beside its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from scanledger.plans.checks import all_checks
from scanledger.plans.queries import all_queries
from tools.check_queries import TABLES, compare

QUERIES, CHECKS = all_queries(), all_checks()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_its_check():
    assert set(CHECKS) == set(QUERIES) <= set(contract.queries())
    assert set(CHECKS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    outcome = compare(spark, con, sf_dir, name, QUERIES[name], CHECKS[name])
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["report_id", "concept", "label", "evidence"] and df.limit(1).count() == 1

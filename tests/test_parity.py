"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from parity import compare, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


OWN = list(oracle.statements())


def test_every_query_of_the_library_has_sql():
    assert set(OWN) <= set(contract.queries())
    assert set(contract._reports()) == set(OWN)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.difference(df, db, contract.oracle_sql()[name]) is None


# Every query that joins, as it runs when neither side is small.
JOINING = [
    "sessions_full",
    "mart_landing_pages",
    "mart_retention",
    "profile_revenue_analysis",
    "fct_order_items",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_matches_sql_without_broadcasts(spark, db, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = contract.queries()[name](spark, SF_DIR)
        assert compare.difference(df, db, contract.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert contract.entry(spark).count() > 0

"""Every driver query against its SQL on the smallest data."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from milepost.catalog import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df, con, contract.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1

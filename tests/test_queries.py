"""Every query of the library against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from tripledger.plans.oracles import ORACLES
from tripledger.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_same_names():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    report = entry.entry(spark)
    assert report.count() > 0 and "reconciliation_status" in report.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []

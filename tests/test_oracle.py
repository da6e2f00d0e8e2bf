"""Every registered query equals its reference SQL, value by value."""

import os

import pytest

import __spark_entry__ as contract
from check_oracle import connect, differences
from conftest import TESTDATA
from stratamart import queries as registry

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_retail_query_has_reference_sql():
    assert registry.queries().keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    assert differences(contract.queries()[name](spark, TESTDATA), duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 21

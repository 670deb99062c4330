"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from compare import connect, differences
from layerloom.suite.oracle import ORACLES
from layerloom.suite.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None

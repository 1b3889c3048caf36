"""Every registered query against its check SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from caderneta.catalog.oracles import ORACLES
from caderneta.catalog.queries import QUERIES
from oracle_check import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_entry(spark):
    assert entry(spark).count() > 20

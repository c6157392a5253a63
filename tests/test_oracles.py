"""Every registered query against its SQL on the smallest test data (the full check runs at sf0.01
with ``python tests/oracle_check.py``)."""

import os

import pytest

from __spark_entry__ import entry
from stratalake.star.oracles import ORACLES
from stratalake.star.queries import registered
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SLOW = {"warehouse_load", "warehouse_two_loads"}  # whole runs are covered by test_pipeline

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(registered()) - SLOW))
def test_query_equals_sql(spark, duck, name):
    assert compare(registered()[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0

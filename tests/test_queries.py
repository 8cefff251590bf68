"""Every registered query against its SQL statement."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect
from epiweave.catalog.oracles import ORACLES
from epiweave.catalog.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["ano", "semana"]
